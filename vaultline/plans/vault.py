"""Declarations of the raw vault: 10 hubs, 8 links, 12 satellites.

Each entry names its staging source(s) and columns; the loaders in
``vaultline.operators.loaders`` do the work.  Sources are names of models
on a ``Warehouse`` (``vaultline.plans.warehouse``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultline.constants import STATUS_RANK


@dataclass(frozen=True)
class HubSpec:
    pk: str
    nk: str
    sources: tuple[str, ...]
    ldts: str = "load_date"


@dataclass(frozen=True)
class LinkSpec:
    pk: str
    fks: tuple[str, ...]
    source: str
    ldts: str = "load_date"
    #: An id of the source that follows from the link key.
    by: str | None = None


@dataclass(frozen=True)
class SatSpec:
    pk: str
    hashdiff: str
    payload: tuple[str, ...]
    source: str
    ldts: str = "load_date"
    event_time: bool = field(default=False)


def status_rank(col: str = "status") -> Column:
    """Lifecycle rank of a status, to order events with equal timestamps."""
    expr = F.lit(99)
    for s, r in sorted(STATUS_RANK.items(), key=lambda kv: kv[1], reverse=True):
        expr = F.when(F.col(col) == s, F.lit(r)).otherwise(expr)
    return expr


HUBS: dict[str, HubSpec] = {
    "hub_patient": HubSpec("patient_hk", "cpf", ("stg_patients", "stg_partner_patients")),
    "hub_practitioner": HubSpec("practitioner_hk", "license_number", ("stg_practitioners",)),
    "hub_facility": HubSpec("facility_hk", "cnes_code", ("stg_facilities",)),
    "hub_specialty": HubSpec("specialty_hk", "specialty_id", ("stg_specialties",)),
    "hub_insurance_provider": HubSpec(
        "insurance_provider_hk", "ans_registration_number", ("stg_insurance_providers",)),
    "hub_exam_type": HubSpec("exam_type_hk", "tuss_code", ("stg_exam_types",)),
    "hub_appointment": HubSpec("appointment_hk", "appointment_id", ("stg_appointments",)),
    "hub_exam": HubSpec("exam_hk", "exam_id", ("stg_exams",)),
    "hub_payment": HubSpec("payment_hk", "payment_id", ("stg_payments",)),
    "hub_feedback": HubSpec("feedback_hk", "feedback_id", ("stg_patient_feedback",)),
}

LINKS: dict[str, LinkSpec] = {
    "lnk_appointment": LinkSpec(
        "lnk_appointment_hk",
        ("appointment_hk", "patient_hk", "practitioner_hk", "facility_hk", "specialty_hk"),
        "stg_appointments", by="appointment_id"),
    "lnk_appointment_insurance": LinkSpec(
        "lnk_appointment_insurance_hk", ("appointment_hk", "insurance_provider_hk"),
        "int_appointments_with_insurance"),
    "lnk_appointment_reschedule": LinkSpec(
        "lnk_appointment_reschedule_hk", ("appointment_hk", "rescheduled_from_hk"),
        "int_appointments_rescheduled"),
    "lnk_exam": LinkSpec(
        "lnk_exam_hk",
        ("exam_hk", "patient_hk", "exam_type_hk", "facility_hk", "source_appointment_hk"),
        "stg_exams", by="exam_id"),
    "lnk_exam_insurance": LinkSpec(
        "lnk_exam_insurance_hk", ("exam_hk", "insurance_provider_hk"), "int_exams_with_insurance"),
    "lnk_payment_appointment": LinkSpec(
        "lnk_payment_hk", ("payment_hk", "reference_hk"), "int_payments_for_appointments"),
    "lnk_payment_exam": LinkSpec(
        "lnk_payment_hk", ("payment_hk", "reference_hk"), "int_payments_for_exams"),
    "lnk_feedback": LinkSpec(
        "lnk_feedback_hk", ("feedback_hk", "patient_hk", "appointment_hk"), "stg_patient_feedback"),
}

SATS: dict[str, SatSpec] = {
    "sat_patient": SatSpec(
        "patient_hk", "hd_patient",
        ("name", "cpf", "birth_date", "sex", "phone", "email", "address", "city", "state"),
        "int_patients_unioned"),
    "sat_practitioner": SatSpec(
        "practitioner_hk", "hd_practitioner",
        ("name", "license_number", "specialty_id", "facility_id", "phone", "email"),
        "stg_practitioners"),
    "sat_facility": SatSpec(
        "facility_hk", "hd_facility", ("name", "address", "city", "state", "phone"),
        "stg_facilities"),
    "sat_specialty": SatSpec("specialty_hk", "hd_specialty", ("name",), "stg_specialties"),
    "sat_insurance_provider": SatSpec(
        "insurance_provider_hk", "hd_insurance_provider", ("name", "ans_registration_number"),
        "stg_insurance_providers"),
    "sat_exam_type": SatSpec(
        "exam_type_hk", "hd_exam_type", ("name", "category", "self_pay_price"), "stg_exam_types"),
    "sat_appointment_detail": SatSpec(
        "appointment_hk", "hd_appointment_detail", ("scheduled_at", "created_at"),
        "stg_appointments"),
    "sat_appointment_status": SatSpec(
        "appointment_hk", "hd_appointment_status", ("status",),
        "stg_appointment_status_history", ldts="status_at", event_time=True),
    "sat_exam_detail": SatSpec(
        "exam_hk", "hd_exam_detail", ("scheduled_at", "created_at"), "stg_exams"),
    "sat_exam_status": SatSpec(
        "exam_hk", "hd_exam_status", ("status",), "stg_exam_status_history",
        ldts="status_at", event_time=True),
    "sat_payment": SatSpec(
        "payment_hk", "hd_payment", ("amount", "payment_method", "payment_status", "paid_at"),
        "stg_payments"),
    "sat_feedback": SatSpec("feedback_hk", "hd_feedback", ("rating", "comments"),
                            "stg_patient_feedback"),
}
