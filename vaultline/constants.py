"""Fixed values shared by the models, the bindings and the checks."""

# Record sources of the three source systems.
SOURCE_CLINIC = "clinic_generator"
SOURCE_PARTNER = "partner_clinic"
SOURCE_SURVEY = "feedback_survey"

# Key prefixes that separate the appointment and exam id spaces.
PREFIX_APPOINTMENT = "APPOINTMENT"
PREFIX_EXAM = "EXAM"

# Domains asserted by the data tests.
STATUSES = ["SCHEDULED", "CONFIRMED", "CANCELLED", "RESCHEDULED", "COMPLETED", "NO_SHOW"]
VISIT_TYPES = ["SELF_PAY", "INSURANCE"]
PAYMENT_METHODS = ["CASH", "CREDIT_CARD", "DEBIT_CARD", "PIX", "BANK_TRANSFER"]
PAYMENT_STATUSES = ["PENDING", "PAID", "REFUNDED", "CANCELLED"]
REFERENCE_TYPES = ["APPOINTMENT", "EXAM"]
SEXES = ["F", "M"]
RATINGS = [1, 2, 3, 4, 5]

# Status lifecycle rank used to order events that share a timestamp:
# SCHEDULED -> CONFIRMED -> one terminal status.
STATUS_RANK = {
    "SCHEDULED": 1,
    "CONFIRMED": 2,
    "COMPLETED": 3,
    "CANCELLED": 3,
    "NO_SHOW": 3,
    "RESCHEDULED": 3,
}

# Batch timestamps and the as-of day used by the driver-table binding
# (fixed so that every run, and the SQL oracle, see the same values).
LOAD_DATE_1 = "2024-02-01 00:00:00"
LOAD_DATE_2 = "2024-02-02 00:00:00"
AS_OF = "1998-12-31"
PIT_DAYS_BACK = 180
# Event-stream point-in-time window (events span 2024-01-01 .. 2024-01-30).
EVENTS_PIT_START = "2024-01-01"
EVENTS_PIT_END = "2024-02-05"
# The written satellite scenario loads the stream up to here first.
EVENTS_SPLIT = "2024-01-15 12:00:00"
# The incremental point-in-time scenario: as-of day of the first run, and the
# day from which some of its events arrive only later.
EVENTS_KNOWN_UNTIL = "2024-01-28"
EVENTS_LATE_FROM = "2024-01-20"
# Incremental batches of the order-based roles split at this day.
BATCH_SPLIT_DAY = "1998-01-01"
