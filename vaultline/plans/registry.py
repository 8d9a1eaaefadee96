"""Named queries over a warehouse root: key -> (spark, root) -> DataFrame.

Keys follow the operator inventory: staging, intermediate, hubs, links,
satellites, business vault, star schema, analytic queries, data tests,
generic loader scenarios, sources and audits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultline.plans.vault import LINKS
from vaultline.plans.warehouse import Warehouse, read_once, reads_rescheduled

Query = Callable[[SparkSession, str], DataFrame]

# query key -> model attribute on Warehouse
MODEL_KEYS: dict[str, str] = {
    "stg_facility": "stg_facilities",
    "stg_specialty": "stg_specialties",
    "stg_insurer": "stg_insurance_providers",
    "stg_exam_type": "stg_exam_types",
    "stg_practitioner": "stg_practitioners",
    "stg_patient": "stg_patients",
    "stg_partner_patient": "stg_partner_patients",
    "stg_appointment": "stg_appointments",
    "stg_appointment_status": "stg_appointment_status_history",
    "stg_exam": "stg_exams",
    "stg_exam_status": "stg_exam_status_history",
    "stg_payment": "stg_payments",
    "stg_feedback": "stg_patient_feedback",
    "int_rescheduled": "int_appointments_rescheduled",
    "int_appt_insured": "int_appointments_with_insurance",
    "int_exam_insured": "int_exams_with_insurance",
    "int_pay_appt": "int_payments_for_appointments",
    "int_pay_exam": "int_payments_for_exams",
    "int_patients_unioned": "int_patients_unioned",
    "hub_patient": "hub_patient",
    "hub_practitioner": "hub_practitioner",
    "hub_facility": "hub_facility",
    "hub_specialty": "hub_specialty",
    "hub_insurer": "hub_insurance_provider",
    "hub_exam_type": "hub_exam_type",
    "hub_appointment": "hub_appointment",
    "hub_exam": "hub_exam",
    "hub_payment": "hub_payment",
    "hub_feedback": "hub_feedback",
    "lnk_appointment": "lnk_appointment",
    "lnk_appt_insurance": "lnk_appointment_insurance",
    "lnk_reschedule": "lnk_appointment_reschedule",
    "lnk_exam": "lnk_exam",
    "lnk_exam_insurance": "lnk_exam_insurance",
    "lnk_pay_appt": "lnk_payment_appointment",
    "lnk_pay_exam": "lnk_payment_exam",
    "lnk_feedback": "lnk_feedback",
    "sat_patient": "sat_patient",
    "sat_practitioner": "sat_practitioner",
    "sat_facility": "sat_facility",
    "sat_specialty": "sat_specialty",
    "sat_insurer": "sat_insurance_provider",
    "sat_exam_type": "sat_exam_type",
    "sat_appt_detail": "sat_appointment_detail",
    "sat_appt_status": "sat_appointment_status",
    "sat_exam_detail": "sat_exam_detail",
    "sat_exam_status": "sat_exam_status",
    "sat_payment": "sat_payment",
    "sat_feedback": "sat_feedback",
    "pit_appointment": "pit_appointment",
    "pit_single_day": "appointment_status_today",
    "bridge_encounter": "bridge_encounter",
    "dim_date": "dim_date",
    "dim_date_window": "dim_date_window",
    "dim_patient": "dim_patient",
    "dim_practitioner": "dim_practitioner",
    "dim_facility": "dim_facility",
    "dim_specialty": "dim_specialty",
    "dim_insurer": "dim_insurance_provider",
    "dim_exam_type": "dim_exam_type",
    "fact_appointment": "fact_appointment",
    "fact_exam": "fact_exam",
    "fact_payment": "fact_payment",
    "fact_feedback": "fact_feedback",
}


METHOD_NEEDS = {
    "q_multi_source": ("sat_patient",),
    "q_status_history": ("hub_appointment", "sat_appointment_status"),
    "q_revenue_by_facility": ("fact_appointment", "dim_facility"),
}


def _model_query(model: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        link = LINKS.get(model)
        wh = Warehouse(spark, root, once=read_once(model), rescheduled=reads_rescheduled(model),
                       deal={link.source: link.by} if link and link.by else None)
        wh.prepare(model)
        return wh.model(model)

    run.__name__ = f"query_{model}"
    return run


def _method_query(method: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        needs = METHOD_NEEDS.get(method, ())
        wh = Warehouse(spark, root, once=read_once(*needs), rescheduled=reads_rescheduled(*needs))
        wh.prepare(*needs)
        return getattr(wh, method)()

    run.__name__ = f"query_{method}"
    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {k: _model_query(m) for k, m in MODEL_KEYS.items()}
    for name in ("q_multi_source", "q_status_history", "q_revenue_by_facility"):
        q[name] = _method_query(name)
    from vaultline.plans.scenarios import SCENARIOS

    q.update(SCENARIOS)
    from vaultline.plans.quality import QUALITY

    q.update(QUALITY)
    from vaultline.plans.ingest import INGEST

    q.update(INGEST)
    return q
