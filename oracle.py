"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL from the model semantics, over the driver's tables
(pre-registered views ``region nation customer supplier part orders
lineitem events ...``).  Hubs, links and satellites use the literal window
forms (``row_number``/``lag``), the point-in-time table uses the literal
spine x history join, so the oracle shares no plan shape with the Spark
code it checks.

Each model is a named CTE; ``sql(final)`` assembles the WITH chain
with only the CTEs a query refers to.
"""

from __future__ import annotations

import re

from vaultline.constants import (
    AS_OF,
    BATCH_SPLIT_DAY,
    EVENTS_PIT_END,
    EVENTS_PIT_START,
    LOAD_DATE_1,
    LOAD_DATE_2,
)

L1 = f"TIMESTAMP '{LOAD_DATE_1}'"
L2 = f"TIMESTAMP '{LOAD_DATE_2}'"
NULLS = "CAST(NULL AS VARCHAR)"


def hk(x: str) -> str:
    return f"sha256(upper(trim(CAST({x} AS VARCHAR))))"


def digits_hk(x: str) -> str:
    return f"sha256(upper(trim(regexp_replace({x}, '[^0-9]', '', 'g'))))"


def pref_hk(prefix: str, x: str) -> str:
    return f"sha256(upper(trim('{prefix}-' || CAST({x} AS VARCHAR))))"


def link_hk(*ks: str) -> str:
    return f"sha256(concat_ws('-', {', '.join(ks)}))"


def opt_link_hk(opt: str, *ks: str) -> str:
    return f"CASE WHEN {opt} IS NULL THEN NULL ELSE {link_hk(*ks)} END"


def hd(*attrs: str | None) -> str:
    parts = ["''" if a is None else f"coalesce(CAST({a} AS VARCHAR), '')" for a in attrs]
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


def method(n: str) -> str:
    return (f"CASE ({n}) % 5 WHEN 0 THEN 'CASH' WHEN 1 THEN 'CREDIT_CARD' "
            f"WHEN 2 THEN 'DEBIT_CARD' WHEN 3 THEN 'PIX' ELSE 'BANK_TRANSFER' END")


def status_rank_sql(col: str = "status") -> str:
    return (f"CASE {col} WHEN 'SCHEDULED' THEN 1 WHEN 'CONFIRMED' THEN 2 "
            "WHEN 'COMPLETED' THEN 3 WHEN 'CANCELLED' THEN 3 WHEN 'NO_SHOW' THEN 3 "
            "WHEN 'RESCHEDULED' THEN 3 ELSE 99 END")


STATUS_RANK_SQL = status_rank_sql()

SELF_PAY = "o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')"
CONFIRMED_AT = "greatest(o_orderdate, coalesce(first_ship, o_orderdate))"
COMPLETED_AT = "greatest(o_orderdate, coalesce(last_ship, o_orderdate))"

CTES: dict[str, str] = {}

# ------------------------------------------------------------------ feeds
CTES["f_facilities"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS facility_id, n_name AS cnes_code, n_name AS name,
       {NULLS} AS address, {NULLS} AS city, CAST(n_regionkey AS VARCHAR) AS state,
       {NULLS} AS phone
FROM nation"""

CTES["f_specialties"] = """
SELECT CAST(r_regionkey AS BIGINT) AS specialty_id, r_name AS name FROM region"""

CTES["f_insurers"] = """
SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) AS BIGINT) AS insurance_provider_id,
       c_mktsegment AS name, c_mktsegment AS ans_registration_number
FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL) s"""

CTES["f_exam_types"] = """
SELECT CAST(p_partkey AS BIGINT) AS exam_type_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS self_pay_price,
       CAST(p_partkey AS VARCHAR) AS tuss_code
FROM part"""

CTES["f_practitioners"] = f"""
SELECT CAST(s_suppkey AS BIGINT) AS practitioner_id, s_name AS name, s_name AS license_number,
       CAST(n_regionkey AS BIGINT) AS specialty_id, CAST(s_nationkey AS BIGINT) AS facility_id,
       {NULLS} AS phone, lower(replace(s_name, '#', '.')) || '@example.org' AS email
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTES["f_patients"] = f"""
SELECT CAST(c_custkey AS BIGINT) AS patient_id, c_name AS name, c_name AS cpf,
       DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
       '+55-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone,
       {NULLS} AS email, {NULLS} AS address, CAST(c_nationkey AS VARCHAR) AS city,
       c_mktsegment AS state, TIMESTAMP '1995-01-01 00:00:00' AS created_at
FROM customer"""

CTES["f_partner_patients"] = f"""
SELECT CAST(c_custkey * 2 AS BIGINT) AS partner_patient_id,
       'CUST-' || regexp_replace(c_name, '[^0-9]', '', 'g') AS cpf,
       upper(c_name) AS name,
       CASE WHEN c_acctbal > 5000 THEN '+55-0-' || CAST(c_custkey AS VARCHAR)
            ELSE '+55-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) END AS phone,
       {NULLS} AS email, CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS state,
       TIMESTAMP '2010-06-01 00:00:00' AS registered_at
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
UNION ALL
SELECT CAST(s_suppkey * 2 + 1 AS BIGINT), '9' || regexp_replace(s_name, '[^0-9]', '', 'g'),
       s_name, {NULLS}, {NULLS}, CAST(s_nationkey AS VARCHAR), {NULLS},
       TIMESTAMP '2010-06-01 00:00:00'
FROM supplier"""

CTES["order_lines"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_returnflag, l_linestatus, l_shipdate, first_ship, last_ship
FROM (SELECT *,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn,
             min(l_shipdate) OVER (PARTITION BY l_orderkey) AS first_ship,
             max(l_shipdate) OVER (PARTITION BY l_orderkey) AS last_ship
      FROM lineitem) x
WHERE rn = 1"""

CTES["order_facts"] = f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       ol.l_orderkey IS NOT NULL AS has_line,
       ol.l_linenumber, ol.l_partkey, ol.l_suppkey, ol.l_quantity, ol.l_extendedprice,
       ol.l_returnflag, ol.l_linestatus, ol.l_shipdate, ol.first_ship, ol.last_ship,
       sp.s_nationkey, sp.n_regionkey, c.c_name,
       CASE WHEN {SELF_PAY} THEN 'SELF_PAY' ELSE 'INSURANCE' END AS visit_type,
       CASE WHEN {SELF_PAY} THEN NULL ELSE ins.insurance_provider_id END AS insurance_provider_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'CONFIRMED'
            ELSE 'SCHEDULED' END AS current_status
FROM orders o
LEFT JOIN order_lines ol ON ol.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT s_suppkey, s_nationkey, n_regionkey
           FROM supplier JOIN nation ON s_nationkey = n_nationkey) sp ON sp.s_suppkey = ol.l_suppkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN f_insurers ins ON ins.name = c.c_mktsegment"""

CTES["f_appointments"] = """
SELECT CAST(o_orderkey AS BIGINT) AS appointment_id,
       CAST(CASE WHEN has_line AND prev_status = 'P' THEN prev_key END AS BIGINT) AS rescheduled_from_id,
       CAST(o_custkey AS BIGINT) AS patient_id, CAST(l_suppkey AS BIGINT) AS practitioner_id,
       CAST(n_regionkey AS BIGINT) AS specialty_id, CAST(s_nationkey AS BIGINT) AS facility_id,
       o_orderdate AS scheduled_at, visit_type, insurance_provider_id, current_status,
       o_orderdate - INTERVAL 7 DAY AS created_at
FROM (SELECT *,
             lag(o_orderkey) OVER w AS prev_key,
             lag(o_orderstatus) OVER w AS prev_status
      FROM order_facts
      WINDOW w AS (PARTITION BY o_custkey, has_line ORDER BY o_orderdate, o_orderkey)) x"""

CTES["f_appointment_status_history"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS appointment_id, 'SCHEDULED' AS status, o_orderdate AS status_at
FROM order_facts
UNION ALL
SELECT CAST(o_orderkey AS BIGINT), 'CONFIRMED', {CONFIRMED_AT}
FROM order_facts WHERE o_orderstatus IN ('P', 'F')
UNION ALL
SELECT CAST(o_orderkey AS BIGINT), 'COMPLETED', {COMPLETED_AT}
FROM order_facts WHERE o_orderstatus = 'F'"""

EXAM_ROWS = "has_line AND l_returnflag = 'R'"

CTES["f_exams"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS exam_id, CAST(o_orderkey AS BIGINT) AS source_appointment_id,
       CAST(o_custkey AS BIGINT) AS patient_id, CAST(l_partkey AS BIGINT) AS exam_type_id,
       CAST(s_nationkey AS BIGINT) AS facility_id, l_shipdate - INTERVAL 10 DAY AS scheduled_at,
       visit_type, insurance_provider_id,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'SCHEDULED' END AS current_status,
       o_orderdate AS created_at
FROM order_facts WHERE {EXAM_ROWS}"""

CTES["f_exam_status_history"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS exam_id, 'SCHEDULED' AS status,
       l_shipdate - INTERVAL 10 DAY AS status_at
FROM order_facts WHERE {EXAM_ROWS}
UNION ALL
SELECT CAST(o_orderkey AS BIGINT), 'COMPLETED', l_shipdate
FROM order_facts WHERE {EXAM_ROWS} AND l_linestatus = 'F'"""

CTES["f_payments"] = f"""
SELECT CAST(o_orderkey * 2 AS BIGINT) AS payment_id, 'APPOINTMENT' AS reference_type,
       CAST(o_orderkey AS BIGINT) AS reference_id, CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
       {method('o_orderkey')} AS payment_method,
       CASE WHEN o_orderstatus = 'F' THEN 'PAID' ELSE 'PENDING' END AS payment_status,
       CASE WHEN o_orderstatus = 'F' THEN {COMPLETED_AT} END AS paid_at
FROM order_facts WHERE has_line AND visit_type = 'SELF_PAY'
UNION ALL
SELECT CAST(o_orderkey * 2 + 1 AS BIGINT), 'EXAM', CAST(o_orderkey AS BIGINT),
       CAST(l_extendedprice AS DECIMAL(10,2)), {method('o_orderkey + 2')},
       CASE WHEN l_linestatus = 'F' THEN 'PAID' ELSE 'PENDING' END,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END
FROM order_facts WHERE has_line AND visit_type = 'SELF_PAY' AND l_returnflag = 'R'"""

RATING = "(CAST(floor(l_quantity) AS INTEGER) % 5 + 1)"
CTES["f_patient_feedback"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS feedback_id, CAST(o_orderkey AS BIGINT) AS appointment_id,
       'CUST-' || regexp_replace(c_name, '[^0-9]', '', 'g') AS cpf,
       CAST({RATING} AS INTEGER) AS rating,
       CASE WHEN {RATING} >= 4 THEN 'good visit' WHEN {RATING} <= 2 THEN 'long wait' END AS comments,
       {COMPLETED_AT} + INTERVAL 1 DAY AS submitted_at
FROM order_facts WHERE has_line AND o_orderstatus = 'F' AND l_returnflag = 'A'"""


# ---------------------------------------------------------------- staging
def _meta(load: str, source: str) -> str:
    return f"{load} AS load_date, '{source}' AS record_source"


def staging_ctes(suffix: str, load: str) -> dict[str, str]:
    """Staging CTEs for one batch (``suffix`` '' for batch 1)."""
    s = suffix
    c: dict[str, str] = {}
    c[f"stg_facilities{s}"] = f"""
SELECT facility_id, cnes_code, name, address, city, state, phone,
       {hk('cnes_code')} AS facility_hk,
       {hd('name', 'address', 'city', 'state', 'phone')} AS hd_facility,
       {_meta(load, 'clinic_generator')}
FROM f_facilities"""
    c[f"stg_specialties{s}"] = f"""
SELECT specialty_id, name, {hk('specialty_id')} AS specialty_hk, {hd('name')} AS hd_specialty,
       {_meta(load, 'clinic_generator')}
FROM f_specialties"""
    c[f"stg_insurance_providers{s}"] = f"""
SELECT insurance_provider_id, name, ans_registration_number,
       {hk('ans_registration_number')} AS insurance_provider_hk,
       {hd('name', 'ans_registration_number')} AS hd_insurance_provider,
       {_meta(load, 'clinic_generator')}
FROM f_insurers"""
    c[f"stg_exam_types{s}"] = f"""
SELECT exam_type_id, name, category, self_pay_price, tuss_code,
       {hk('tuss_code')} AS exam_type_hk,
       {hd('name', 'category', 'self_pay_price')} AS hd_exam_type,
       {_meta(load, 'clinic_generator')}
FROM f_exam_types"""
    c[f"stg_practitioners{s}"] = f"""
SELECT practitioner_id, name, license_number, specialty_id, facility_id, phone, email,
       {hk('license_number')} AS practitioner_hk,
       {hd('name', 'license_number', 'specialty_id', 'facility_id', 'phone', 'email')} AS hd_practitioner,
       {_meta(load, 'clinic_generator')}
FROM f_practitioners"""
    c[f"stg_patients{s}"] = f"""
SELECT patient_id, name, cpf, birth_date, sex, phone, email, address, city, state, created_at,
       {digits_hk('cpf')} AS patient_hk,
       {hd('name', 'cpf', 'birth_date', 'sex', 'phone', 'email', 'address', 'city', 'state')} AS hd_patient,
       {_meta(load, 'clinic_generator')}
FROM f_patients"""
    c[f"stg_partner_patients{s}"] = f"""
SELECT partner_patient_id, name, cpf, CAST(NULL AS DATE) AS birth_date, {NULLS} AS sex,
       phone, email, {NULLS} AS address, city, state, registered_at AS created_at,
       {digits_hk('cpf')} AS patient_hk,
       {hd('name', 'cpf', None, None, 'phone', 'email', None, 'city', 'state')} AS hd_patient,
       {_meta(load, 'partner_clinic')}
FROM f_partner_patients"""
    c[f"stg_appointments{s}"] = f"""
SELECT *,
       {link_hk('appointment_hk', 'patient_hk', 'practitioner_hk', 'facility_hk', 'specialty_hk')} AS lnk_appointment_hk,
       {opt_link_hk('insurance_provider_hk', 'appointment_hk', 'insurance_provider_hk')} AS lnk_appointment_insurance_hk,
       {opt_link_hk('rescheduled_from_hk', 'appointment_hk', 'rescheduled_from_hk')} AS lnk_appointment_reschedule_hk,
       {hd('scheduled_at', 'created_at')} AS hd_appointment_detail,
       {_meta(load, 'clinic_generator')}
FROM (
  SELECT s.appointment_id, s.rescheduled_from_id, s.patient_id, s.practitioner_id, s.specialty_id,
         s.facility_id, s.scheduled_at, s.visit_type, s.insurance_provider_id, s.current_status,
         s.created_at,
         {pref_hk('APPOINTMENT', 's.appointment_id')} AS appointment_hk,
         CASE WHEN s.rescheduled_from_id IS NULL THEN NULL
              ELSE {pref_hk('APPOINTMENT', 's.rescheduled_from_id')} END AS rescheduled_from_hk,
         p.patient_hk, pr.practitioner_hk, {hk('s.specialty_id')} AS specialty_hk,
         f.facility_hk, ip.insurance_provider_hk
  FROM f_appointments s
  JOIN stg_patients{s} p ON p.patient_id = s.patient_id
  JOIN stg_practitioners{s} pr ON pr.practitioner_id = s.practitioner_id
  JOIN stg_facilities{s} f ON f.facility_id = s.facility_id
  LEFT JOIN stg_insurance_providers{s} ip ON ip.insurance_provider_id = s.insurance_provider_id
) x"""
    c[f"stg_appointment_status_history{s}"] = f"""
SELECT appointment_id, status, status_at,
       {pref_hk('APPOINTMENT', 'appointment_id')} AS appointment_hk,
       {hd('status')} AS hd_appointment_status,
       {_meta(load, 'clinic_generator')}
FROM f_appointment_status_history"""
    c[f"stg_exams{s}"] = f"""
SELECT *,
       {link_hk('exam_hk', 'patient_hk', 'exam_type_hk', 'facility_hk', 'source_appointment_hk')} AS lnk_exam_hk,
       {opt_link_hk('insurance_provider_hk', 'exam_hk', 'insurance_provider_hk')} AS lnk_exam_insurance_hk,
       {hd('scheduled_at', 'created_at')} AS hd_exam_detail,
       {_meta(load, 'clinic_generator')}
FROM (
  SELECT s.exam_id, s.source_appointment_id, s.patient_id, s.exam_type_id, s.facility_id,
         s.scheduled_at, s.visit_type, s.insurance_provider_id, s.current_status, s.created_at,
         {pref_hk('EXAM', 's.exam_id')} AS exam_hk,
         {pref_hk('APPOINTMENT', 's.source_appointment_id')} AS source_appointment_hk,
         p.patient_hk, et.exam_type_hk, f.facility_hk, ip.insurance_provider_hk
  FROM f_exams s
  JOIN stg_patients{s} p ON p.patient_id = s.patient_id
  JOIN stg_exam_types{s} et ON et.exam_type_id = s.exam_type_id
  JOIN stg_facilities{s} f ON f.facility_id = s.facility_id
  LEFT JOIN stg_insurance_providers{s} ip ON ip.insurance_provider_id = s.insurance_provider_id
) x"""
    c[f"stg_exam_status_history{s}"] = f"""
SELECT exam_id, status, status_at,
       {pref_hk('EXAM', 'exam_id')} AS exam_hk,
       {hd('status')} AS hd_exam_status,
       {_meta(load, 'clinic_generator')}
FROM f_exam_status_history"""
    c[f"stg_payments{s}"] = f"""
SELECT payment_id, reference_type, reference_id, amount, payment_method, payment_status, paid_at,
       {hk('payment_id')} AS payment_hk,
       sha256(upper(trim(reference_type || '-' || CAST(reference_id AS VARCHAR)))) AS reference_hk,
       sha256(upper(trim(concat_ws('-', CAST(payment_id AS VARCHAR), reference_type,
                                   CAST(reference_id AS VARCHAR))))) AS lnk_payment_hk,
       {hd('amount', 'payment_method', 'payment_status', 'paid_at')} AS hd_payment,
       {_meta(load, 'clinic_generator')}
FROM f_payments"""
    c[f"stg_patient_feedback{s}"] = f"""
SELECT feedback_id, appointment_id, cpf, rating, comments, submitted_at,
       {hk('feedback_id')} AS feedback_hk,
       {pref_hk('APPOINTMENT', 'appointment_id')} AS appointment_hk,
       {digits_hk('cpf')} AS patient_hk,
       {link_hk(hk('feedback_id'), digits_hk('cpf'), pref_hk('APPOINTMENT', 'appointment_id'))} AS lnk_feedback_hk,
       {hd('rating', 'comments')} AS hd_feedback,
       {_meta(load, 'feedback_survey')}
FROM f_patient_feedback"""
    c[f"int_appointments_rescheduled{s}"] = f"SELECT * FROM stg_appointments{s} WHERE rescheduled_from_hk IS NOT NULL"
    c[f"int_appointments_with_insurance{s}"] = f"SELECT * FROM stg_appointments{s} WHERE insurance_provider_hk IS NOT NULL"
    c[f"int_exams_with_insurance{s}"] = f"SELECT * FROM stg_exams{s} WHERE insurance_provider_hk IS NOT NULL"
    c[f"int_payments_for_appointments{s}"] = f"SELECT * FROM stg_payments{s} WHERE reference_type = 'APPOINTMENT'"
    c[f"int_payments_for_exams{s}"] = f"SELECT * FROM stg_payments{s} WHERE reference_type = 'EXAM'"
    cols = ("name, cpf, birth_date, sex, phone, email, address, city, state, created_at, "
            "patient_hk, hd_patient, load_date, record_source")
    c[f"int_patients_unioned{s}"] = (
        f"SELECT {cols} FROM stg_patients{s} UNION ALL SELECT {cols} FROM stg_partner_patients{s}")
    return c


CTES.update(staging_ctes("", L1))


# ------------------------------------------------------------ vault loads
def hub_sql(pk: str, nk: str, sources: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {pk}, {nk}, load_date, record_source, {i} AS src_order FROM {s}"
        for i, s in enumerate(sources))
    return f"""
SELECT {pk}, {nk}, load_date, record_source FROM (
  SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY load_date, src_order, {nk}) AS rn
  FROM ({parts}) u WHERE {pk} IS NOT NULL) x
WHERE rn = 1"""


def link_sql(pk: str, fks: list[str], source: str) -> str:
    cols = ", ".join(fks)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in [pk, *fks])
    return f"""
SELECT {pk}, {cols}, load_date, record_source FROM (
  SELECT {pk}, {cols}, load_date, record_source,
         row_number() OVER (PARTITION BY {pk} ORDER BY load_date, {cols}) AS rn
  FROM {source} WHERE {nn}) x
WHERE rn = 1"""


def sat_sql(pk: str, hdc: str, payload: list[str], source: str, ldts: str = "load_date",
            tie: str = "0") -> str:
    cols = ", ".join([pk, hdc, *payload, ldts, "record_source"])
    return f"""
SELECT {cols} FROM (
  SELECT {cols},
         lag({hdc}) OVER (PARTITION BY {pk}, record_source ORDER BY {ldts}, {tie}, {hdc}) AS prev_hd
  FROM {source} WHERE {pk} IS NOT NULL) x
WHERE prev_hd IS NULL OR prev_hd <> {hdc}"""


HUB_DEFS = {
    "hub_patient": ("patient_hk", "cpf", ["stg_patients", "stg_partner_patients"]),
    "hub_practitioner": ("practitioner_hk", "license_number", ["stg_practitioners"]),
    "hub_facility": ("facility_hk", "cnes_code", ["stg_facilities"]),
    "hub_specialty": ("specialty_hk", "specialty_id", ["stg_specialties"]),
    "hub_insurance_provider": ("insurance_provider_hk", "ans_registration_number",
                               ["stg_insurance_providers"]),
    "hub_exam_type": ("exam_type_hk", "tuss_code", ["stg_exam_types"]),
    "hub_appointment": ("appointment_hk", "appointment_id", ["stg_appointments"]),
    "hub_exam": ("exam_hk", "exam_id", ["stg_exams"]),
    "hub_payment": ("payment_hk", "payment_id", ["stg_payments"]),
    "hub_feedback": ("feedback_hk", "feedback_id", ["stg_patient_feedback"]),
}
LINK_DEFS = {
    "lnk_appointment": ("lnk_appointment_hk", ["appointment_hk", "patient_hk", "practitioner_hk",
                                               "facility_hk", "specialty_hk"], "stg_appointments"),
    "lnk_appointment_insurance": ("lnk_appointment_insurance_hk",
                                  ["appointment_hk", "insurance_provider_hk"],
                                  "int_appointments_with_insurance"),
    "lnk_appointment_reschedule": ("lnk_appointment_reschedule_hk",
                                   ["appointment_hk", "rescheduled_from_hk"],
                                   "int_appointments_rescheduled"),
    "lnk_exam": ("lnk_exam_hk", ["exam_hk", "patient_hk", "exam_type_hk", "facility_hk",
                                 "source_appointment_hk"], "stg_exams"),
    "lnk_exam_insurance": ("lnk_exam_insurance_hk", ["exam_hk", "insurance_provider_hk"],
                           "int_exams_with_insurance"),
    "lnk_payment_appointment": ("lnk_payment_hk", ["payment_hk", "reference_hk"],
                                "int_payments_for_appointments"),
    "lnk_payment_exam": ("lnk_payment_hk", ["payment_hk", "reference_hk"], "int_payments_for_exams"),
    "lnk_feedback": ("lnk_feedback_hk", ["feedback_hk", "patient_hk", "appointment_hk"],
                     "stg_patient_feedback"),
}
SAT_DEFS = {
    "sat_patient": ("patient_hk", "hd_patient", ["name", "cpf", "birth_date", "sex", "phone",
                                                 "email", "address", "city", "state"],
                    "int_patients_unioned", "load_date", "0"),
    "sat_practitioner": ("practitioner_hk", "hd_practitioner",
                         ["name", "license_number", "specialty_id", "facility_id", "phone", "email"],
                         "stg_practitioners", "load_date", "0"),
    "sat_facility": ("facility_hk", "hd_facility", ["name", "address", "city", "state", "phone"],
                     "stg_facilities", "load_date", "0"),
    "sat_specialty": ("specialty_hk", "hd_specialty", ["name"], "stg_specialties", "load_date", "0"),
    "sat_insurance_provider": ("insurance_provider_hk", "hd_insurance_provider",
                               ["name", "ans_registration_number"], "stg_insurance_providers",
                               "load_date", "0"),
    "sat_exam_type": ("exam_type_hk", "hd_exam_type", ["name", "category", "self_pay_price"],
                      "stg_exam_types", "load_date", "0"),
    "sat_appointment_detail": ("appointment_hk", "hd_appointment_detail",
                               ["scheduled_at", "created_at"], "stg_appointments", "load_date", "0"),
    "sat_appointment_status": ("appointment_hk", "hd_appointment_status", ["status"],
                               "stg_appointment_status_history", "status_at", STATUS_RANK_SQL),
    "sat_exam_detail": ("exam_hk", "hd_exam_detail", ["scheduled_at", "created_at"], "stg_exams",
                        "load_date", "0"),
    "sat_exam_status": ("exam_hk", "hd_exam_status", ["status"], "stg_exam_status_history",
                        "status_at", STATUS_RANK_SQL),
    "sat_payment": ("payment_hk", "hd_payment",
                    ["amount", "payment_method", "payment_status", "paid_at"], "stg_payments",
                    "load_date", "0"),
    "sat_feedback": ("feedback_hk", "hd_feedback", ["rating", "comments"], "stg_patient_feedback",
                     "load_date", "0"),
}
for _n, (_pk, _nk, _src) in HUB_DEFS.items():
    CTES[_n] = hub_sql(_pk, _nk, _src)
for _n, (_pk, _fks, _src) in LINK_DEFS.items():
    CTES[_n] = link_sql(_pk, _fks, _src)
for _n, (_pk, _hd, _pl, _src, _ldts, _tie) in SAT_DEFS.items():
    CTES[_n] = sat_sql(_pk, _hd, _pl, _src, _ldts, _tie)

# -------------------------------------------------------- business vault
CTES["pit_today"] = f"""
SELECT appointment_hk, status AS status_as_of, status_at AS sat_appointment_status_ldts FROM (
  SELECT h.appointment_hk, s.status, s.status_at,
         row_number() OVER (PARTITION BY h.appointment_hk
                            ORDER BY s.status_at DESC, {status_rank_sql('s.status')} DESC, s.status DESC) AS rn
  FROM hub_appointment h
  JOIN stg_appointment_status_history s
    ON s.appointment_hk = h.appointment_hk AND s.status_at <= TIMESTAMP '{AS_OF} 00:00:00') x
WHERE rn = 1"""

# Everything linked to an appointment as one tagged list, turned into one column
# per kind.
CTES["encounter_list"] = """
SELECT 'insurer' AS kind, appointment_hk AS visit, insurance_provider_hk AS item FROM lnk_appointment_insurance
UNION ALL SELECT 'payment', reference_hk, payment_hk FROM lnk_payment_appointment
UNION ALL SELECT 'feedback', appointment_hk, feedback_hk FROM lnk_feedback
UNION ALL SELECT 'exam', source_appointment_hk, exam_hk FROM lnk_exam
UNION ALL SELECT 'exam type', source_appointment_hk, exam_type_hk FROM lnk_exam
UNION ALL SELECT 'exam payment', source_appointment_hk, payment_hk
          FROM lnk_exam, lnk_payment_exam WHERE exam_hk = reference_hk"""


def _of_kind(kind: str, column: str) -> str:
    return f"max(item) FILTER (kind = '{kind}') AS {column}"


CTES["bridge_encounter"] = f"""
SELECT appointment_hk, patient_hk, practitioner_hk, facility_hk, specialty_hk,
       {_of_kind('insurer', 'appointment_insurance_provider_hk')}, {_of_kind('exam', 'exam_hk')},
       {_of_kind('exam type', 'exam_type_hk')}, {_of_kind('payment', 'appointment_payment_hk')},
       {_of_kind('exam payment', 'exam_payment_hk')}, {_of_kind('feedback', 'feedback_hk')}
FROM lnk_appointment LEFT JOIN encounter_list ON visit = appointment_hk
GROUP BY ALL"""

# ------------------------------------------------------------------ gold
CTES["dim_patient"] = """
SELECT h.patient_hk, r.name, r.cpf, r.birth_date, r.sex, r.phone, r.email, r.address, r.city,
       r.state, r.record_source AS golden_record_source
FROM hub_patient h
JOIN (SELECT *, row_number() OVER (
        PARTITION BY patient_hk
        ORDER BY CASE WHEN record_source = 'clinic_generator' THEN 0 ELSE 1 END,
                 load_date DESC, hd_patient) AS rn
      FROM sat_patient) r ON r.patient_hk = h.patient_hk AND r.rn = 1"""
CTES["dim_practitioner"] = """
SELECT practitioner_hk, practitioner_id, name, license_number, specialty_id, facility_id, phone, email
FROM stg_practitioners"""
CTES["dim_facility"] = """
SELECT facility_hk, facility_id, cnes_code, name, address, city, state, phone FROM stg_facilities"""
CTES["dim_specialty"] = "SELECT specialty_hk, specialty_id, name FROM stg_specialties"
CTES["dim_insurance_provider"] = """
SELECT insurance_provider_hk, insurance_provider_id, name, ans_registration_number
FROM stg_insurance_providers"""
CTES["dim_exam_type"] = """
SELECT exam_type_hk, exam_type_id, tuss_code, name, category, self_pay_price FROM stg_exam_types"""
CTES["dim_date"] = """
SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
       CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
       CAST(month(date_day) AS INTEGER) AS month, monthname(date_day) AS month_name,
       CAST(day(date_day) AS INTEGER) AS day_of_month,
       CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, dayname(date_day) AS day_name,
       dayofweek(date_day) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM (SELECT min(d) AS s, max(d) AS e FROM (
              SELECT CAST(scheduled_at AS DATE) AS d FROM stg_appointments
              UNION ALL SELECT CAST(scheduled_at AS DATE) FROM stg_exams
              UNION ALL SELECT CAST(paid_at AS DATE) FROM stg_payments
              UNION ALL SELECT CAST(submitted_at AS DATE) FROM stg_patient_feedback) u) b) days"""
CTES["dim_date_window"] = """
SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
       CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
       CAST(month(date_day) AS INTEGER) AS month, monthname(date_day) AS month_name,
       CAST(day(date_day) AS INTEGER) AS day_of_month,
       CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, dayname(date_day) AS day_name,
       dayofweek(date_day) IN (0, 6) AS is_weekend
FROM (SELECT CAST(max(scheduled_at) AS DATE) + unnest(range(-730, 366))::INTEGER AS date_day
      FROM stg_appointments) days"""
# Facts straight from staging: what refers to an appointment is stacked, one
# row per thing, and folded to one row per appointment.
CTES["appointment_details"] = """
SELECT appointment_hk, max(exam_hk) AS exam_hk, max(exam_type_hk) AS exam_type_hk, max(feedback_hk) AS feedback_hk,
       max(rating) AS feedback_rating, max(amount) AS amount_paid, max(payment_method) AS payment_method,
       max(payment_status) AS payment_status, max(status_as_of) AS status_as_of
FROM (SELECT source_appointment_hk AS appointment_hk, exam_hk, exam_type_hk FROM stg_exams
      UNION ALL BY NAME
      SELECT appointment_hk, feedback_hk, rating FROM stg_patient_feedback
      UNION ALL BY NAME
      SELECT reference_hk AS appointment_hk, amount, payment_method, payment_status
      FROM stg_payments WHERE reference_type = 'APPOINTMENT'
      UNION ALL BY NAME
      SELECT appointment_hk, status_as_of FROM pit_today) things
GROUP BY appointment_hk"""
CTES["fact_appointment"] = """
SELECT appointment_id, appointment_hk, patient_hk, practitioner_hk, facility_hk, specialty_hk,
       insurance_provider_hk, exam_hk, exam_type_hk, feedback_hk,
       CAST(strftime(scheduled_at, '%Y%m%d') AS INTEGER) AS scheduled_date_key, visit_type,
       coalesce(status_as_of, current_status) AS current_status, amount_paid, payment_method, payment_status,
       feedback_rating, exam_hk IS NOT NULL AS has_exam, feedback_hk IS NOT NULL AS has_feedback,
       1 AS appointment_count
FROM stg_appointments LEFT JOIN appointment_details USING (appointment_hk)"""
CTES["fact_exam"] = """
SELECT exam_id, exam_hk, source_appointment_hk AS appointment_hk, patient_hk, facility_hk, exam_type_hk,
       insurance_provider_hk, CAST(strftime(scheduled_at, '%Y%m%d') AS INTEGER) AS scheduled_date_key,
       visit_type, current_status, amount AS amount_paid, payment_method, payment_status, 1 AS exam_count
FROM stg_exams LEFT JOIN (
  SELECT reference_hk AS exam_hk, amount, payment_method, payment_status
  FROM stg_payments WHERE reference_type = 'EXAM') USING (exam_hk)"""
CTES["fact_payment"] = """
SELECT payment_id, payment_hk, reference_type, reference_hk, amount, payment_method,
       payment_status, CAST(strftime(paid_at, '%Y%m%d') AS INTEGER) AS paid_date_key
FROM stg_payments"""
CTES["fact_feedback"] = """
SELECT feedback_id, feedback_hk, appointment_hk, patient_hk, rating, comments,
       CAST(strftime(submitted_at, '%Y%m%d') AS INTEGER) AS submitted_date_key
FROM stg_patient_feedback"""


# -------------------------------------------------------------- assembly
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(body: str) -> list[str]:
    return [w for w in dict.fromkeys(_WORD.findall(body)) if w in CTES]


def sql(final: str) -> str:
    """``WITH`` chain of every CTE ``final`` needs (transitively), in order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()) -> None:
        if name in seen:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for d in _deps(final):
        visit(d)
    if not order:
        return final
    chain = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    return f"WITH {chain}\n{final}"


def model(name: str) -> str:
    return sql(f"SELECT * FROM {name}")


# ---------------------------------------------------------- query oracles
def _model_oracles() -> dict[str, str]:
    from vaultline.plans.registry import MODEL_KEYS

    out = {}
    for key, m in MODEL_KEYS.items():
        cte = "pit_today" if m == "appointment_status_today" else m
        out[key] = model(cte)
    return out


def oracle_queries() -> dict[str, str]:
    q = _model_oracles()
    q.update(scenario_oracles())
    q.update(audit_oracles())
    q.update(ingest_oracles())
    q["q_multi_source"] = sql("""
SELECT patient_hk, count(DISTINCT record_source) AS source_count
FROM sat_patient GROUP BY patient_hk HAVING count(DISTINCT record_source) > 1""")
    q["q_status_history"] = sql("""
SELECT * FROM sat_appointment_status
WHERE appointment_hk = (SELECT min(appointment_hk) FROM hub_appointment)
ORDER BY status_at, status""")
    q["q_revenue_by_facility"] = sql("""
SELECT f.name AS facility, CAST(sum(fa.amount_paid) AS DECIMAL(20,2)) AS revenue
FROM fact_appointment fa JOIN dim_facility f ON f.facility_hk = fa.facility_hk
WHERE fa.visit_type = 'SELF_PAY'
GROUP BY f.name ORDER BY revenue DESC""")
    return q


# ------------------------------------------------------ loader scenarios
import datetime as _dt  # noqa: E402

CTES.update(staging_ctes("_b2", L2))
_SPLIT = f"TIMESTAMP '{BATCH_SPLIT_DAY} 00:00:00'"


def _order_customers(load: str, where: str = "") -> str:
    return f"""
SELECT {hk('o_custkey')} AS customer_hk, o_custkey AS customer_id,
       {load} AS load_date, 'orders' AS record_source
FROM orders {where}"""


CTES["oc_l1"] = _order_customers(L1)
CTES["oc_early_l1"] = _order_customers(L1, f"WHERE o_orderdate < {_SPLIT}")
CTES["oc_all_l2"] = _order_customers(L2)
CTES["ev_users_l1"] = f"""
SELECT {hk('user_id')} AS customer_hk, user_id AS customer_id, {L1} AS load_date,
       'events' AS record_source
FROM events"""


def _line_feed(load: str, where: str = "") -> str:
    return f"""
SELECT *, {link_hk('order_hk', 'part_hk', 'supplier_hk')} AS lnk_order_line_hk FROM (
  SELECT {hk('l_orderkey')} AS order_hk, {hk('l_partkey')} AS part_hk,
         {hk('l_suppkey')} AS supplier_hk, {load} AS load_date, 'lineitem' AS record_source
  FROM lineitem {where}) x"""


CTES["lf_l1"] = _line_feed(L1)
CTES["lf_inc"] = (_line_feed(L1, f"WHERE l_shipdate < {_SPLIT}") + "\nUNION ALL\n"
                  + _line_feed(L2))


def _customer_feed(load: str, drift: bool) -> str:
    bal = "CAST(c_acctbal AS DECIMAL(12,2))"
    if drift:
        bal = f"CAST(CASE WHEN c_acctbal < 0 THEN {bal} + 100 ELSE {bal} END AS DECIMAL(12,2))"
    return f"""
SELECT *, {hd('name', 'segment', 'nation', 'balance')} AS hd_customer FROM (
  SELECT {hk('c_custkey')} AS customer_hk, c_name AS name, c_mktsegment AS segment,
         c_nationkey AS nation, {bal} AS balance, {load} AS load_date,
         'customer' AS record_source
  FROM customer) x"""


CTES["cs_l1"] = _customer_feed(L1, False)
CTES["cs_incremental"] = _customer_feed(L1, False) + "\nUNION ALL\n" + _customer_feed(L2, True)
CTES["cs_rerun"] = _customer_feed(L1, False) + "\nUNION ALL\n" + _customer_feed(L2, False)
CTES["user_events"] = f"""
SELECT {hk('user_id')} AS user_hk, event_id, event_type, ts, {hd('event_type')} AS hd_event,
       'events' AS record_source
FROM events"""
CTES["patients_two_loads"] = "SELECT * FROM int_patients_unioned UNION ALL SELECT * FROM int_patients_unioned_b2"

_CUST_PAYLOAD = ["name", "segment", "nation", "balance"]
_AS_OF_DAY = _dt.date.fromisoformat(AS_OF)
_PIT_START = _AS_OF_DAY - _dt.timedelta(days=180)

CTES["pit_appointment"] = f"""
SELECT appointment_hk, snapshot_date, status AS status_as_of,
       status_at AS sat_appointment_status_ldts FROM (
  SELECT sp.appointment_hk, sp.snapshot_date, s.status, s.status_at,
         row_number() OVER (PARTITION BY sp.appointment_hk, sp.snapshot_date
                            ORDER BY s.status_at DESC, {status_rank_sql('s.status')} DESC,
                                     s.status DESC) AS rn
  FROM (SELECT h.appointment_hk, CAST(d AS DATE) AS snapshot_date
        FROM hub_appointment h
        CROSS JOIN range(DATE '{_PIT_START}', DATE '{_AS_OF_DAY + _dt.timedelta(days=1)}',
                         INTERVAL 1 DAY) t(d)) sp
  JOIN stg_appointment_status_history s
    ON s.appointment_hk = sp.appointment_hk
   AND s.status_at <= CAST(sp.snapshot_date AS TIMESTAMP)) x
WHERE rn = 1"""

_EV_END = _dt.date.fromisoformat(EVENTS_PIT_END) + _dt.timedelta(days=1)
CTES["pit_events"] = f"""
SELECT user_id, snapshot_date, event_type AS status_as_of, ts AS status_at FROM (
  SELECT sp.user_id, sp.snapshot_date, e.event_type, e.ts,
         row_number() OVER (PARTITION BY sp.user_id, sp.snapshot_date
                            ORDER BY e.ts DESC, e.event_id DESC) AS rn
  FROM (SELECT c_custkey AS user_id, CAST(d AS DATE) AS snapshot_date
        FROM customer CROSS JOIN range(DATE '{EVENTS_PIT_START}', DATE '{_EV_END}',
                                       INTERVAL 1 DAY) t(d)) sp
  JOIN events e ON e.user_id = sp.user_id AND e.ts <= CAST(sp.snapshot_date AS TIMESTAMP)) x
WHERE rn = 1"""


def scenario_oracles() -> dict[str, str]:
    q = {}
    q["hub_load"] = sql(hub_sql("customer_hk", "customer_id", ["oc_l1"]))
    q["hub_multi_source"] = sql(hub_sql("customer_hk", "customer_id", ["oc_l1", "ev_users_l1"]))
    q["hub_incremental"] = sql(hub_sql("customer_hk", "customer_id", ["oc_early_l1", "oc_all_l2"]))
    fks = ["order_hk", "part_hk", "supplier_hk"]
    q["link_load"] = sql(link_sql("lnk_order_line_hk", fks, "lf_l1"))
    q["link_incremental"] = sql(link_sql("lnk_order_line_hk", fks, "lf_inc"))
    q["sat_initial"] = sql(sat_sql("customer_hk", "hd_customer", _CUST_PAYLOAD, "cs_l1"))
    q["sat_incremental"] = sql(sat_sql("customer_hk", "hd_customer", _CUST_PAYLOAD,
                                       "cs_incremental"))
    q["sat_idempotent_rerun"] = sql(sat_sql("customer_hk", "hd_customer", _CUST_PAYLOAD,
                                            "cs_rerun"))
    q["sat_change_detect"] = sql(sat_sql("user_hk", "hd_event", ["event_id", "event_type"],
                                         "user_events", "ts", "event_id"))
    q["sat_event_time"] = sql("SELECT * FROM sat_appointment_status")
    # Written targets end as the same batches chained in memory, or loaded at once.
    q["hub_written"], q["link_written"] = q["hub_incremental"], q["link_incremental"]
    q["sat_written"] = q["sat_change_detect"]
    pk, hdc, pl, _, _, _ = SAT_DEFS["sat_patient"]
    q["sat_multi_source"] = sql(sat_sql(pk, hdc, pl, "patients_two_loads"))
    q["pit_status"] = q["pit_incremental"] = sql("SELECT * FROM pit_events")
    q["pit_daily_status_counts"] = sql("""
SELECT snapshot_date, status_as_of, count(*) AS appointments
FROM pit_appointment GROUP BY snapshot_date, status_as_of""")
    return q


# ------------------------------------------------------ tests and audits
def _lit(v) -> str:
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _check_sql(c) -> str:
    head = f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, "
    n = "CAST(count(*) AS BIGINT) AS failures"
    if c.test == "unique":
        return (head + n + f" FROM (SELECT {c.column} FROM {c.model} WHERE {c.column} IS NOT NULL "
                f"GROUP BY {c.column} HAVING count(*) > 1) x")
    if c.test == "not_null":
        return head + n + f" FROM {c.model} WHERE {c.column} IS NULL"
    if c.test == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.values)
        return head + n + f" FROM {c.model} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})"
    return (head + n + f" FROM {c.model} m WHERE m.{c.column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {c.to_model} p WHERE p.{c.to_field} = m.{c.column})")


def dq_oracle(tests=None) -> str:
    from vaultline.plans.quality import all_checks

    parts = [_check_sql(c) for c in all_checks() if tests is None or c.test in tests]
    return sql("\nUNION ALL\n".join(parts))


def _audit_sql(audit: str, entity: str, src: str, bad: str) -> str:
    return (f"SELECT '{audit}' AS audit, '{entity}' AS entity, "
            f"CAST(count(*) AS BIGINT) AS rows_checked, "
            f"CAST(coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations "
            f"FROM {src}")


def _latest_sql(table: str, key: str) -> str:
    return (f"(SELECT {key}, status AS latest_status FROM (SELECT *, row_number() OVER ("
            f"PARTITION BY {key} ORDER BY status_at DESC, {STATUS_RANK_SQL} DESC, status DESC) AS rn "
            f"FROM {table}) y WHERE rn = 1)")


def audit_oracles() -> dict[str, str]:
    q = {}
    q["audit_status_match"] = sql(
        _audit_sql("status_match", "appointment",
                   "stg_appointments a LEFT JOIN "
                   + _latest_sql("stg_appointment_status_history", "appointment_hk")
                   + " l ON l.appointment_hk = a.appointment_hk",
                   "l.latest_status IS DISTINCT FROM a.current_status")
        + "\nUNION ALL\n"
        + _audit_sql("status_match", "exam",
                     "stg_exams a LEFT JOIN " + _latest_sql("stg_exam_status_history", "exam_hk")
                     + " l ON l.exam_hk = a.exam_hk",
                     "l.latest_status IS DISTINCT FROM a.current_status"))
    ins_bad = "(visit_type = 'INSURANCE') <> (insurance_provider_hk IS NOT NULL)"
    q["audit_insurance"] = sql(
        _audit_sql("insurance", "appointment", "stg_appointments", ins_bad) + "\nUNION ALL\n"
        + _audit_sql("insurance", "exam", "stg_exams", ins_bad))
    q["audit_selfpay"] = sql(_audit_sql(
        "selfpay", "payment",
        "stg_payments p LEFT JOIN (SELECT appointment_hk AS reference_hk, visit_type "
        "FROM stg_appointments UNION ALL SELECT exam_hk, visit_type FROM stg_exams) t "
        "ON t.reference_hk = p.reference_hk",
        "t.visit_type IS NULL OR t.visit_type <> 'SELF_PAY'"))
    q["audit_paid_at"] = sql(_audit_sql(
        "paid_at", "payment", "stg_payments",
        "(payment_status IN ('PAID', 'REFUNDED')) <> (paid_at IS NOT NULL)"))
    q["audit_feedback"] = sql(_audit_sql(
        "feedback", "feedback",
        "stg_patient_feedback f LEFT JOIN stg_appointments a ON a.appointment_hk = f.appointment_hk",
        "a.current_status IS DISTINCT FROM 'COMPLETED'"))
    q["audit_bridge_grain"] = sql(
        _audit_sql("bridge_grain", "exam_per_appointment",
                   "(SELECT source_appointment_hk, count(*) AS n FROM lnk_exam GROUP BY 1) x", "n > 1")
        + "\nUNION ALL\n"
        + _audit_sql("bridge_grain", "bridge_rows_per_appointment",
                     "(SELECT appointment_hk, count(*) AS n FROM bridge_encounter GROUP BY 1) x",
                     "n > 1"))
    q["audit_orphans"] = sql(
        _audit_sql("orphans", "appointment",
                   "f_appointments f LEFT JOIN (SELECT appointment_id, 1 AS kept FROM stg_appointments) s "
                   "ON s.appointment_id = f.appointment_id", "s.kept IS NULL")
        + "\nUNION ALL\n"
        + _audit_sql("orphans", "exam",
                     "f_exams f LEFT JOIN (SELECT exam_id, 1 AS kept FROM stg_exams) s "
                     "ON s.exam_id = f.exam_id", "s.kept IS NULL"))
    from vaultline.constants import PAYMENT_METHODS, PAYMENT_STATUSES, STATUSES, VISIT_TYPES

    domains = {"status": STATUSES, "visit_type": VISIT_TYPES,
               "payment_method": PAYMENT_METHODS, "payment_status": PAYMENT_STATUSES}
    values = ", ".join(f"('{d}', '{v}')" for d, vs in domains.items() for v in vs)
    q["ref_values"] = sql(f"""
SELECT r.domain, r.value, CAST(coalesce(c.n, 0) AS BIGINT) AS rows_using
FROM (VALUES {values}) r(domain, value)
LEFT JOIN (SELECT domain, value, count(*) AS n FROM (
    SELECT 'status' AS domain, status AS value FROM stg_appointment_status_history
    UNION ALL SELECT 'status', status FROM stg_exam_status_history
    UNION ALL SELECT 'visit_type', visit_type FROM stg_appointments
    UNION ALL SELECT 'visit_type', visit_type FROM stg_exams
    UNION ALL SELECT 'payment_method', payment_method FROM stg_payments
    UNION ALL SELECT 'payment_status', payment_status FROM stg_payments) u
  GROUP BY domain, value) c ON c.domain = r.domain AND c.value = r.value""")
    q["dq_report"] = dq_oracle()
    q["dq_unique"] = dq_oracle(["unique"])
    q["dq_not_null"] = dq_oracle(["not_null"])
    q["dq_accepted_values"] = dq_oracle(["accepted_values"])
    q["dq_relationships"] = dq_oracle(["relationships"])
    return q


def ingest_oracles() -> dict[str, str]:
    return {
        "scan_feed": model("stg_patients"),
        "scan_union_extracts": sql(f"""
SELECT *, DATE '2024-02-01' AS extract_date FROM f_appointment_status_history
WHERE status_at < {_SPLIT}
UNION ALL
SELECT *, DATE '2024-02-02' AS extract_date FROM f_appointment_status_history"""),
        "scan_new_extracts": sql(f"""
SELECT 1 AS run, *, DATE '2024-02-01' AS extract_date FROM f_appointment_status_history
WHERE status_at < {_SPLIT}
UNION ALL
SELECT 2 AS run, *, DATE '2024-02-02' AS extract_date FROM f_appointment_status_history"""),
    }
