"""The thirteen source feeds, derived from the driver's TPC-H-like tables.

Each function returns a DataFrame with exactly the columns (and types after
staging casts) of one source feed, so the staging models in
``vaultline.plans.staging`` run unchanged over CSV feeds
(``vaultline.sources.feeds``) or over this binding.

Role binding (see README):
    facility          <- nation
    specialty         <- region
    insurer           <- distinct customer.c_mktsegment
    exam type         <- part
    practitioner      <- supplier + nation
    patient           <- customer (CPF-like code = digits of c_name)
    partner patient   <- customers of three segments (other code format,
                         drifted phone) + suppliers as partner-only people
    appointment       <- orders + their first line item (practitioner)
    status history    <- order date / first ship / last ship
    exam              <- first line of an order when it was returned ('R')
    payment           <- self-pay orders and their exams
    feedback          <- completed orders whose first line has flag 'A'

Every order-level feed is computed from ``order_facts``: lineitem is reduced
to one row per order with a single aggregate (partial aggregation
map-side), then joined to orders on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.constants import PAYMENT_METHODS
from vaultline.functions.dates import ntz
from vaultline.operators.sequence import previous_value
from vaultline.sources.tables import Tables

PARTNER_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
SELF_PAY_PRIORITIES = ["4-NOT SPECIFIED", "5-LOW"]
PATIENT_CREATED_AT = "1995-01-01 00:00:00"
PARTNER_REGISTERED_AT = "2010-06-01 00:00:00"


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _digits(c: str) -> Column:
    return F.regexp_replace(F.col(c), "[^0-9]", "")


def _phone(nation: str, key: str) -> Column:
    return F.concat(
        F.lit("+55-"), F.col(nation).cast("string"), F.lit("-"), F.col(key).cast("string")
    )


def _method(n: Column) -> Column:
    m = F.pmod(n, F.lit(len(PAYMENT_METHODS)))
    expr = F.lit(PAYMENT_METHODS[-1])
    for i in reversed(range(len(PAYMENT_METHODS) - 1)):
        expr = F.when(m == i, F.lit(PAYMENT_METHODS[i])).otherwise(expr)
    return expr


# --------------------------------------------------------------- master data


def facilities(t: Tables) -> DataFrame:
    n = t("nation")
    return n.select(
        F.col("n_nationkey").cast("long").alias("facility_id"),
        F.col("n_name").alias("cnes_code"),
        F.col("n_name").alias("name"),
        _null_str().alias("address"),
        _null_str().alias("city"),
        F.col("n_regionkey").cast("string").alias("state"),
        _null_str().alias("phone"),
    )


def specialties(t: Tables) -> DataFrame:
    return t("region").select(
        F.col("r_regionkey").cast("long").alias("specialty_id"),
        F.col("r_name").alias("name"),
    )


def insurance_providers(t: Tables) -> DataFrame:
    """One provider per market segment, numbered by segment text.

    The window runs after ``distinct``: its input is the segment domain
    (a handful of rows), not the customer table.
    """
    segs = t("customer").select("c_mktsegment").filter(F.col("c_mktsegment").isNotNull()).distinct()
    return segs.select(
        F.row_number().over(Window.orderBy("c_mktsegment")).cast("long").alias("insurance_provider_id"),
        F.col("c_mktsegment").alias("name"),
        F.col("c_mktsegment").alias("ans_registration_number"),
    )


def exam_types(t: Tables) -> DataFrame:
    return t("part").select(
        F.col("p_partkey").cast("long").alias("exam_type_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("self_pay_price"),
        F.col("p_partkey").cast("string").alias("tuss_code"),
    )


def practitioners(t: Tables) -> DataFrame:
    s = t("supplier")
    n = t("nation").select("n_nationkey", "n_regionkey")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("s_suppkey").cast("long").alias("practitioner_id"),
        F.col("s_name").alias("name"),
        F.col("s_name").alias("license_number"),
        F.col("n_regionkey").cast("long").alias("specialty_id"),
        F.col("s_nationkey").cast("long").alias("facility_id"),
        _null_str().alias("phone"),
        F.concat(
            F.lower(F.regexp_replace(F.col("s_name"), "#", ".")), F.lit("@example.org")
        ).alias("email"),
    )


def patients(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("patient_id"),
        F.col("c_name").alias("name"),
        F.col("c_name").alias("cpf"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(F.col("c_custkey"), F.lit(18000)).cast("int")).alias("birth_date"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        _phone("c_nationkey", "c_custkey").alias("phone"),
        _null_str().alias("email"),
        _null_str().alias("address"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("c_mktsegment").alias("state"),
        ntz(PATIENT_CREATED_AT).alias("created_at"),
    )


def partner_patients(t: Tables) -> DataFrame:
    """Partner registry: overlapping customers (other code format, drifted
    phone for high balances) plus suppliers as people only the partner knows.

    Partner ids: 2*custkey for customers, 2*suppkey+1 for suppliers.
    """
    c = t("customer").filter(F.col("c_mktsegment").isin(*PARTNER_SEGMENTS))
    from_customers = c.select(
        (F.col("c_custkey") * 2).cast("long").alias("partner_patient_id"),
        F.concat(F.lit("CUST-"), _digits("c_name")).alias("cpf"),
        F.upper(F.col("c_name")).alias("name"),
        F.when(
            F.col("c_acctbal") > 5000,
            F.concat(F.lit("+55-0-"), F.col("c_custkey").cast("string")),
        ).otherwise(_phone("c_nationkey", "c_custkey")).alias("phone"),
        _null_str().alias("email"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("c_mktsegment").alias("state"),
        ntz(PARTNER_REGISTERED_AT).alias("registered_at"),
    )
    s = t("supplier")
    from_suppliers = s.select(
        (F.col("s_suppkey") * 2 + 1).cast("long").alias("partner_patient_id"),
        F.concat(F.lit("9"), _digits("s_name")).alias("cpf"),
        F.col("s_name").alias("name"),
        _null_str().alias("phone"),
        _null_str().alias("email"),
        F.col("s_nationkey").cast("string").alias("city"),
        _null_str().alias("state"),
        ntz(PARTNER_REGISTERED_AT).alias("registered_at"),
    )
    return from_customers.unionByName(from_suppliers)


# ----------------------------------------------------------- order-level facts


def order_lines(t: Tables) -> DataFrame:
    """Per order: its first line (by line number, part, supplier) and the
    first/last ship dates -- one aggregate over lineitem, partial map-side.

    Spark sorts each task's lines by order for it (the buffers hold strings).
    A sort-free form, with the position as one decimal, a ``min_by`` per column
    and the codes as numbers, took three times as long (sf0.1: 2.6 s
    against 0.8 s): 128-bit decimals cost more than the sort saves. The position
    leads the struct, so its minimum is the first line and no second copy of the
    position is shuffled beside it.
    """
    li = t("lineitem")
    first = F.min(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    ))
    return li.groupBy("l_orderkey").agg(
        first.alias("fl"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    ).select(
        "l_orderkey",
        *[F.col("fl")[c].alias(c) for c in (
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
        )],
        "first_ship",
        "last_ship",
    )


def order_facts(t: Tables) -> DataFrame:
    """Orders with first line, practitioner's nation/region, customer segment,
    insurer id, visit type and status -- the shared base of order feeds."""
    o = t("orders")
    ol = order_lines(t)
    sup = (
        t("supplier")
        .join(t("nation").select("n_nationkey", "n_regionkey"),
              F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .select("s_suppkey", "s_nationkey", "n_regionkey")
    )
    # Insurers are numbered by segment text.  The few names are one sorted array
    # (a scalar subquery) and the id is the place in it, so nothing is ever
    # dealt out or joined by the handful of segment values.
    names = insurance_providers(t).agg(F.sort_array(F.collect_list("name"))).scalar()
    cust = t("customer").select(
        "c_custkey", "c_name", F.nullif(F.array_position(names, F.col("c_mktsegment")), F.lit(0)).alias("_ins_id"))
    self_pay = F.col("o_orderpriority").isin(*SELF_PAY_PRIORITIES)
    j = (
        o.join(ol, o["o_orderkey"] == ol["l_orderkey"], "left")
        .join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    return j.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.col("l_orderkey").isNotNull().alias("has_line"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate", "first_ship", "last_ship",
        "s_nationkey", "n_regionkey", "c_name",
        F.when(self_pay, F.lit("SELF_PAY")).otherwise(F.lit("INSURANCE")).alias("visit_type"),
        F.when(self_pay, F.lit(None).cast("long")).otherwise(F.col("_ins_id")).alias("insurance_provider_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("COMPLETED"))
        .when(F.col("o_orderstatus") == "P", F.lit("CONFIRMED"))
        .otherwise(F.lit("SCHEDULED")).alias("current_status"),
    )


def _confirmed_at() -> Column:
    return F.greatest(F.col("o_orderdate"), F.coalesce(F.col("first_ship"), F.col("o_orderdate")))


def _completed_at() -> Column:
    return F.greatest(F.col("o_orderdate"), F.coalesce(F.col("last_ship"), F.col("o_orderdate")))


def appointments(t: Tables, facts: DataFrame | None = None, rescheduled: bool = True) -> DataFrame:
    """Appointment feed.  ``rescheduled_from_id`` = the customer's previous
    order (by date, key) among orders that have a line, if it was 'P'.
    ``rescheduled=False`` leaves that column out, and with it the windows over
    each customer's orders, which no other column needs."""
    f = facts if facts is not None else order_facts(t)
    if not rescheduled:
        return f.select(*_appointment_columns())
    f = f.withColumn("_prev", F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")))
    # Day buckets: a customer holding a large share of all orders is split
    # over many window partitions instead of one task.
    f = previous_value(
        f, ["o_custkey", "has_line"], ["o_orderdate", "o_orderkey"], "_prev", "_prev_order",
        bucket=F.to_date("o_orderdate"),
    )
    resched = F.when(
        F.col("has_line") & (F.col("_prev_order")["s"] == "P"), F.col("_prev_order")["k"]
    )
    first, *others = _appointment_columns()
    return f.select(first, resched.cast("long").alias("rescheduled_from_id"), *others)


def _appointment_columns() -> list[Column]:
    return [
        F.col("o_orderkey").cast("long").alias("appointment_id"),
        F.col("o_custkey").cast("long").alias("patient_id"),
        F.col("l_suppkey").cast("long").alias("practitioner_id"),
        F.col("n_regionkey").cast("long").alias("specialty_id"),
        F.col("s_nationkey").cast("long").alias("facility_id"),
        F.col("o_orderdate").alias("scheduled_at"),
        F.col("visit_type"),
        F.col("insurance_provider_id"),
        F.col("current_status"),
        (F.col("o_orderdate") - F.expr("INTERVAL 7 DAYS")).alias("created_at"),
    ]


def appointment_status_history(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    """SCHEDULED at the order date; CONFIRMED (P, F) at the first ship date;
    COMPLETED (F) at the last ship date; ship dates clamped to the order date.
    One pass: an array of candidate events per order, exploded."""
    f = facts if facts is not None else order_facts(t)
    st = F.col("o_orderstatus")
    ev = F.array(
        F.struct(F.lit("SCHEDULED").alias("status"), F.col("o_orderdate").alias("status_at")),
        F.struct(
            F.when(st.isin("P", "F"), F.lit("CONFIRMED")).alias("status"),
            _confirmed_at().alias("status_at"),
        ),
        F.struct(
            F.when(st == "F", F.lit("COMPLETED")).alias("status"),
            _completed_at().alias("status_at"),
        ),
    )
    return (
        f.select(F.col("o_orderkey").cast("long").alias("appointment_id"), F.explode(ev).alias("e"))
        .filter(F.col("e.status").isNotNull())
        .select("appointment_id", F.col("e.status").alias("status"), F.col("e.status_at").alias("status_at"))
    )


def _exam_facts(f: DataFrame) -> DataFrame:
    return f.filter(F.col("has_line") & (F.col("l_returnflag") == "R"))


def exams(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    f = _exam_facts(facts if facts is not None else order_facts(t))
    return f.select(
        F.col("o_orderkey").cast("long").alias("exam_id"),
        F.col("o_orderkey").cast("long").alias("source_appointment_id"),
        F.col("o_custkey").cast("long").alias("patient_id"),
        F.col("l_partkey").cast("long").alias("exam_type_id"),
        F.col("s_nationkey").cast("long").alias("facility_id"),
        (F.col("l_shipdate") - F.expr("INTERVAL 10 DAYS")).alias("scheduled_at"),
        "visit_type",
        "insurance_provider_id",
        F.when(F.col("l_linestatus") == "F", F.lit("COMPLETED")).otherwise(F.lit("SCHEDULED")).alias("current_status"),
        F.col("o_orderdate").alias("created_at"),
    )


def exam_status_history(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    f = _exam_facts(facts if facts is not None else order_facts(t))
    ev = F.array(
        F.struct(
            F.lit("SCHEDULED").alias("status"),
            (F.col("l_shipdate") - F.expr("INTERVAL 10 DAYS")).alias("status_at"),
        ),
        F.struct(
            F.when(F.col("l_linestatus") == "F", F.lit("COMPLETED")).alias("status"),
            F.col("l_shipdate").alias("status_at"),
        ),
    )
    return (
        f.select(F.col("o_orderkey").cast("long").alias("exam_id"), F.explode(ev).alias("e"))
        .filter(F.col("e.status").isNotNull())
        .select("exam_id", F.col("e.status").alias("status"), F.col("e.status_at").alias("status_at"))
    )


def payments(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    """Self-pay appointments (order total) and their exams (line price).
    Payment ids: 2*orderkey for the appointment, 2*orderkey+1 for the exam."""
    f = (facts if facts is not None else order_facts(t)).filter(
        F.col("has_line") & (F.col("visit_type") == "SELF_PAY")
    )
    done = F.col("o_orderstatus") == "F"
    appt = f.select(
        (F.col("o_orderkey") * 2).cast("long").alias("payment_id"),
        F.lit("APPOINTMENT").alias("reference_type"),
        F.col("o_orderkey").cast("long").alias("reference_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        _method(F.col("o_orderkey")).alias("payment_method"),
        F.when(done, F.lit("PAID")).otherwise(F.lit("PENDING")).alias("payment_status"),
        F.when(done, _completed_at()).alias("paid_at"),
    )
    ex = _exam_facts(f)
    line_done = F.col("l_linestatus") == "F"
    exam = ex.select(
        (F.col("o_orderkey") * 2 + 1).cast("long").alias("payment_id"),
        F.lit("EXAM").alias("reference_type"),
        F.col("o_orderkey").cast("long").alias("reference_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        _method(F.col("o_orderkey") + 2).alias("payment_method"),
        F.when(line_done, F.lit("PAID")).otherwise(F.lit("PENDING")).alias("payment_status"),
        F.when(line_done, F.col("l_shipdate")).alias("paid_at"),
    )
    return appt.unionByName(exam)


def patient_feedback(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    f = (facts if facts is not None else order_facts(t)).filter(
        F.col("has_line") & (F.col("o_orderstatus") == "F") & (F.col("l_returnflag") == "A")
    )
    rating = (F.pmod(F.floor(F.col("l_quantity")).cast("int"), F.lit(5)) + 1).cast("int")
    return f.select(
        F.col("o_orderkey").cast("long").alias("feedback_id"),
        F.col("o_orderkey").cast("long").alias("appointment_id"),
        F.concat(F.lit("CUST-"), _digits("c_name")).alias("cpf"),
        rating.alias("rating"),
        F.when(rating >= 4, F.lit("good visit")).when(rating <= 2, F.lit("long wait")).alias("comments"),
        (_completed_at() + F.expr("INTERVAL 1 DAYS")).alias("submitted_at"),
    )
