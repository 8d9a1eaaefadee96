"""The warehouse's data tests (142) and the audit queries.

Declarations for staging, business vault and gold are listed as fixed
values; hub, link and satellite tests follow one rule per kind and are
generated from the vault declarations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.constants import (
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    RATINGS,
    REFERENCE_TYPES,
    SEXES,
    STATUSES,
    VISIT_TYPES,
)
from vaultline.operators.checks import Check, run_checks
from vaultline.plans.vault import HUBS, LINKS, SATS, status_rank
from vaultline.plans.warehouse import Warehouse, read_once

U, N, AV, REL = "unique", "not_null", "accepted_values", "relationships"

# Declared tests per model, as (model, column, tests, accepted values).
_DECLARED = [
    ("stg_facilities", "facility_id", (U, N), ()),
    ("stg_facilities", "facility_hk", (U, N), ()),
    ("stg_specialties", "specialty_id", (U, N), ()),
    ("stg_specialties", "specialty_hk", (U, N), ()),
    ("stg_insurance_providers", "insurance_provider_id", (U, N), ()),
    ("stg_insurance_providers", "insurance_provider_hk", (U, N), ()),
    ("stg_exam_types", "exam_type_id", (U, N), ()),
    ("stg_exam_types", "exam_type_hk", (U, N), ()),
    ("stg_practitioners", "practitioner_id", (U, N), ()),
    ("stg_practitioners", "practitioner_hk", (U, N), ()),
    ("stg_patients", "patient_id", (U, N), ()),
    ("stg_patients", "patient_hk", (U, N), ()),
    ("stg_patients", "sex", (AV,), tuple(SEXES)),
    ("stg_appointments", "appointment_id", (U, N), ()),
    ("stg_appointments", "appointment_hk", (U, N), ()),
    ("stg_appointments", "visit_type", (AV,), tuple(VISIT_TYPES)),
    ("stg_appointments", "current_status", (AV,), tuple(STATUSES)),
    ("stg_appointment_status_history", "appointment_id", (N,), ()),
    ("stg_appointment_status_history", "status", (AV,), tuple(STATUSES)),
    ("stg_exams", "exam_id", (U, N), ()),
    ("stg_exams", "exam_hk", (U, N), ()),
    ("stg_exams", "visit_type", (AV,), tuple(VISIT_TYPES)),
    ("stg_exams", "current_status", (AV,), tuple(STATUSES)),
    ("stg_exam_status_history", "exam_id", (N,), ()),
    ("stg_exam_status_history", "status", (AV,), tuple(STATUSES)),
    ("stg_partner_patients", "partner_patient_id", (U, N), ()),
    ("stg_partner_patients", "patient_hk", (U, N), ()),
    ("stg_patient_feedback", "feedback_id", (U, N), ()),
    ("stg_patient_feedback", "feedback_hk", (U, N), ()),
    ("stg_patient_feedback", "rating", (AV,), tuple(RATINGS)),
    ("stg_payments", "payment_id", (U, N), ()),
    ("stg_payments", "reference_type", (AV,), tuple(REFERENCE_TYPES)),
    ("stg_payments", "payment_method", (AV,), tuple(PAYMENT_METHODS)),
    ("stg_payments", "payment_status", (AV,), tuple(PAYMENT_STATUSES)),
    ("pit_appointment", "appointment_hk", (N,), ()),
    ("pit_appointment", "snapshot_date", (N,), ()),
    ("pit_appointment", "status_as_of", (N,), ()),
    ("bridge_encounter", "appointment_hk", (U, N), ()),
    ("dim_date", "date_key", (U, N), ()),
    ("dim_patient", "patient_hk", (U, N), ()),
    ("dim_practitioner", "practitioner_hk", (U, N), ()),
    ("dim_facility", "facility_hk", (U, N), ()),
    ("dim_specialty", "specialty_hk", (U, N), ()),
    ("dim_insurance_provider", "insurance_provider_hk", (U, N), ()),
    ("dim_exam_type", "exam_type_hk", (U, N), ()),
    ("fact_appointment", "appointment_hk", (U, N), ()),
    ("fact_exam", "exam_hk", (U, N), ()),
    ("fact_payment", "payment_hk", (U, N), ()),
    ("fact_feedback", "feedback_hk", (U, N), ()),
    ("fact_feedback", "rating", (AV,), tuple(RATINGS)),
]
_RELATIONSHIPS = [("fact_appointment", "patient_hk", "dim_patient", "patient_hk")]


def all_checks() -> list[Check]:
    out: list[Check] = []
    for model, col, tests, values in _DECLARED:
        for t in tests:
            out.append(Check(model, col, t, values if t == AV else ()))
    for name, h in HUBS.items():
        out += [Check(name, h.pk, U), Check(name, h.pk, N), Check(name, h.nk, N)]
    for name, lk in LINKS.items():
        out += [Check(name, lk.pk, U), Check(name, lk.pk, N)]
    for name, s in SATS.items():
        out.append(Check(name, s.pk, N))
    for model, col, to_model, to_field in _RELATIONSHIPS:
        out.append(Check(model, col, REL, to_model=to_model, to_field=to_field))
    return out


def dq(spark, root, tests=None) -> DataFrame:
    checks = [c for c in all_checks() if tests is None or c.test in tests]
    models = sorted({c.model for c in checks} | {c.to_model for c in checks if c.to_model})
    # No test is on a column of the rescheduled link but those of its own table.
    wh = Warehouse(spark, root, once=read_once(*models), rescheduled="lnk_appointment_reschedule" in models)
    wh.prepare(*models)
    return run_checks(spark, checks, wh.model)


def dq_report(spark, root):
    return dq(spark, root)


def dq_unique(spark, root):
    return dq(spark, root, [U])


def dq_not_null(spark, root):
    return dq(spark, root, [N])


def dq_accepted_values(spark, root):
    return dq(spark, root, [AV])


def dq_relationships(spark, root):
    return dq(spark, root, [REL])


# ------------------------------------------------------------------ audits
# Output of every audit: (audit, entity, rows_checked, violations).


def _audit(df: DataFrame, audit: str, entity: str, bad) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("violations"),
    ).select(
        F.lit(audit).alias("audit"), F.lit(entity).alias("entity"),
        F.col("rows_checked").cast("bigint").alias("rows_checked"),
        F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"),
    )


def _warehouse(spark, root, *once: str) -> Warehouse:
    """For audits, which read none of the rescheduled link; ``once`` as there."""
    return Warehouse(spark, root, once=frozenset(once), rescheduled=False)


def _latest_status(history: DataFrame, key: str) -> DataFrame:
    order = F.struct(F.col("status_at"), status_rank("status"), F.col("status"))
    return history.groupBy(key).agg(F.max_by(F.col("status"), order).alias("latest_status"))


def audit_status_match(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Latest history status equals the entity's current status."""
    wh = wh or _warehouse(spark, root, "stg_appointments", "stg_exams")
    a = wh.model("stg_appointments").join(
        _latest_status(wh.model("stg_appointment_status_history"), "appointment_hk"), "appointment_hk", "left")
    e = wh.model("stg_exams").join(_latest_status(wh.model("stg_exam_status_history"), "exam_hk"), "exam_hk", "left")
    bad = ~F.col("latest_status").eqNullSafe(F.col("current_status"))
    return _audit(a, "status_match", "appointment", bad).unionByName(
        _audit(e, "status_match", "exam", bad))


def audit_insurance(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Insurance provider present iff visit type is INSURANCE."""
    wh = wh or _warehouse(spark, root, "stg_appointments", "stg_exams")
    bad = (F.col("visit_type") == "INSURANCE") != F.col("insurance_provider_hk").isNotNull()
    return _audit(wh.model("stg_appointments"), "insurance", "appointment", bad).unionByName(
        _audit(wh.model("stg_exams"), "insurance", "exam", bad))


def audit_selfpay(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Payments reference an existing self-pay appointment or exam."""
    wh = wh or _warehouse(spark, root, "stg_appointments", "stg_exams")
    targets = wh.model("stg_appointments").select(
        F.col("appointment_hk").alias("reference_hk"), "visit_type").unionByName(
        wh.model("stg_exams").select(F.col("exam_hk").alias("reference_hk"), "visit_type"))
    p = wh.model("stg_payments").select("reference_hk").join(targets, "reference_hk", "left")
    bad = F.col("visit_type").isNull() | (F.col("visit_type") != "SELF_PAY")
    return _audit(p, "selfpay", "payment", bad)


def audit_paid_at(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """paid_at is set iff the payment is PAID or REFUNDED."""
    wh = wh or _warehouse(spark, root)
    bad = F.col("payment_status").isin("PAID", "REFUNDED") != F.col("paid_at").isNotNull()
    return _audit(wh.model("stg_payments"), "paid_at", "payment", bad)


def audit_feedback(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Feedback only on existing COMPLETED appointments."""
    wh = wh or _warehouse(spark, root, "stg_appointments")
    f = wh.model("stg_patient_feedback").select("appointment_hk").join(
        wh.model("stg_appointments").select("appointment_hk", "current_status"), "appointment_hk", "left")
    bad = ~F.col("current_status").eqNullSafe(F.lit("COMPLETED"))
    return _audit(f, "feedback", "feedback", bad)


def audit_bridge_grain(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """At most one exam per appointment; the bridge has one row per appointment."""
    wh = wh or _warehouse(spark, root)
    exams = wh.model("lnk_exam").groupBy("source_appointment_hk").agg(F.count(F.lit(1)).alias("n"))
    bridge = wh.model("bridge_encounter").groupBy("appointment_hk").agg(F.count(F.lit(1)).alias("n"))
    return _audit(exams, "bridge_grain", "exam_per_appointment", F.col("n") > 1).unionByName(
        _audit(bridge, "bridge_grain", "bridge_rows_per_appointment", F.col("n") > 1))


def audit_orphans(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Feed rows dropped by the mandatory key lookups of staging."""
    wh = wh or _warehouse(spark, root, "stg_appointments", "stg_exams")
    out = None
    for entity, feed, stg, key in (
        ("appointment", "appointments", wh.model("stg_appointments"), "appointment_id"),
        ("exam", "exams", wh.model("stg_exams"), "exam_id"),
    ):
        f = wh.feed(feed).select(key).join(stg.select(key, F.lit(1).alias("_kept")), key, "left")
        part = _audit(f, "orphans", entity, F.col("_kept").isNull())
        out = part if out is None else out.unionByName(part)
    return out


def ref_values(spark, root, wh: Warehouse | None = None) -> DataFrame:
    """Domain lists as reference tables with their use in staging:
    (domain, value, rows_using)."""
    wh = wh or _warehouse(spark, root, "stg_appointments", "stg_exams")
    uses = [
        ("status", wh.model("stg_appointment_status_history"), "status"),
        ("status", wh.model("stg_exam_status_history"), "status"),
        ("visit_type", wh.model("stg_appointments"), "visit_type"),
        ("visit_type", wh.model("stg_exams"), "visit_type"),
        ("payment_method", wh.model("stg_payments"), "payment_method"),
        ("payment_status", wh.model("stg_payments"), "payment_status"),
    ]
    used = None
    for domain, df, col in uses:
        part = df.select(F.lit(domain).alias("domain"), F.col(col).alias("value"))
        used = part if used is None else used.unionByName(part)
    counts = used.groupBy("domain", "value").agg(F.count(F.lit(1)).alias("rows_using"))
    domains = {"status": STATUSES, "visit_type": VISIT_TYPES,
               "payment_method": PAYMENT_METHODS, "payment_status": PAYMENT_STATUSES}
    ref = spark.createDataFrame(
        [(d, v) for d, vs in domains.items() for v in vs], "domain string, value string")
    return ref.join(counts, ["domain", "value"], "left").select(
        "domain", "value", F.coalesce(F.col("rows_using"), F.lit(0)).cast("bigint").alias("rows_using"))


QUALITY = {
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_report": dq_report,
    "audit_status_match": audit_status_match,
    "audit_insurance": audit_insurance,
    "audit_selfpay": audit_selfpay,
    "audit_paid_at": audit_paid_at,
    "audit_feedback": audit_feedback,
    "audit_bridge_grain": audit_bridge_grain,
    "audit_orphans": audit_orphans,
    "ref_values": ref_values,
}
