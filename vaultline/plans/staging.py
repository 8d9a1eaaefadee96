"""The thirteen staging models and six intermediate views.

Each function takes typed feed DataFrames (from CSV feeds or the driver
binding) plus the batch ``load_date`` and returns the staging table.
``keep`` writes a feed with its looked-up business keys and reads it back: the hash
keys that follow from its columns are then derived where they are read.
Lookups of hub keys for transactional feeds are equi-joins on the internal
id: the three mandatory ones are inner joins (orphans are dropped, as in the
source model), the optional insurer lookup is a left join.  Join strategy is
left to the planner: small dimensions fall under the broadcast threshold and
are broadcast, larger ones are shuffled; AQE re-plans from runtime sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.constants import (
    PREFIX_APPOINTMENT,
    PREFIX_EXAM,
    SOURCE_CLINIC,
    SOURCE_PARTNER,
    SOURCE_SURVEY,
)
from vaultline.functions.keys import (
    digits_key,
    hash_key,
    link_key,
    optional_link_key,
    prefixed_key,
    raw_link_key,
    typed_reference_key,
)
from vaultline.operators.stage import stage


def _c(name: str, typ: str | None = None) -> Column:
    c = F.col(name)
    return (c.cast(typ) if typ else c).alias(name)


def stg_facilities(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("facility_id", "bigint"), "cnes_code", "name", "address", "city", "state", "phone"],
        keys={"facility_hk": hash_key("cnes_code")},
        diffs={"hd_facility": ["name", "address", "city", "state", "phone"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_specialties(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("specialty_id", "bigint"), "name"],
        keys={"specialty_hk": hash_key(F.col("specialty_id").cast("bigint"))},
        diffs={"hd_specialty": ["name"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_insurance_providers(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("insurance_provider_id", "bigint"), "name", "ans_registration_number"],
        keys={"insurance_provider_hk": hash_key("ans_registration_number")},
        diffs={"hd_insurance_provider": ["name", "ans_registration_number"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_exam_types(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("exam_type_id", "bigint"), "name", "category",
         _c("self_pay_price", "decimal(10,2)"), "tuss_code"],
        keys={"exam_type_hk": hash_key("tuss_code")},
        diffs={"hd_exam_type": ["name", "category", "self_pay_price"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_practitioners(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("practitioner_id", "bigint"), "name", "license_number",
         _c("specialty_id", "bigint"), _c("facility_id", "bigint"), "phone", "email"],
        keys={"practitioner_hk": hash_key("license_number")},
        diffs={"hd_practitioner": ["name", "license_number", "specialty_id",
                                   "facility_id", "phone", "email"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_patients(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("patient_id", "bigint"), "name", "cpf", _c("birth_date", "date"), "sex",
         "phone", "email", "address", "city", "state", _c("created_at", "timestamp_ntz")],
        keys={"patient_hk": digits_key("cpf")},
        diffs={"hd_patient": ["name", "cpf", "birth_date", "sex", "phone", "email",
                              "address", "city", "state"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_partner_patients(feed: DataFrame, load_date: Column) -> DataFrame:
    """Narrower second source: absent attributes become typed NULLs and hash
    as '' in the same positions as the main feed."""
    return stage(
        feed,
        [_c("partner_patient_id", "bigint"), "name", "cpf",
         F.lit(None).cast("date").alias("birth_date"),
         F.lit(None).cast("string").alias("sex"),
         "phone", "email",
         F.lit(None).cast("string").alias("address"),
         "city", "state",
         F.col("registered_at").cast("timestamp_ntz").alias("created_at")],
        keys={"patient_hk": digits_key("cpf")},
        diffs={"hd_patient": ["name", "cpf", None, None, "phone", "email", None,
                              "city", "state"]},
        record_source=SOURCE_PARTNER,
        load_date=load_date,
    )


def stg_appointments(
    feed: DataFrame,
    patients: DataFrame,
    practitioners: DataFrame,
    facilities: DataFrame,
    insurers: DataFrame,
    load_date: Column,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    rescheduled: bool = True,
) -> DataFrame:
    """``rescheduled=False``: without the columns of the rescheduled link, for a
    feed that lacks ``rescheduled_from_id``."""
    # The business keys ride along instead of the hashes that follow from them.
    a = keep(
        feed.join(patients.select("patient_id", "cpf"), "patient_id", "inner")
        .join(practitioners.select("practitioner_id", "license_number"), "practitioner_id", "inner")
        .join(facilities.select("facility_id", "cnes_code"), "facility_id", "inner")
        .join(insurers.select("insurance_provider_id", "ans_registration_number"),
              "insurance_provider_id", "left")
    )
    link = {
        "rescheduled_from_hk": prefixed_key(PREFIX_APPOINTMENT, F.col("rescheduled_from_id").cast("bigint")),
    } if rescheduled else {}
    return stage(
        a,
        [_c("appointment_id", "bigint"), *[_c("rescheduled_from_id", "bigint")] * rescheduled,
         _c("patient_id", "bigint"), _c("practitioner_id", "bigint"),
         _c("specialty_id", "bigint"), _c("facility_id", "bigint"),
         _c("scheduled_at", "timestamp_ntz"), "visit_type",
         _c("insurance_provider_id", "bigint"), "current_status",
         _c("created_at", "timestamp_ntz")],
        keys={
            "appointment_hk": prefixed_key(PREFIX_APPOINTMENT, F.col("appointment_id").cast("bigint")),
            **link,
            "patient_hk": digits_key("cpf"),
            "practitioner_hk": hash_key("license_number"),
            "specialty_hk": hash_key(F.col("specialty_id").cast("bigint")),
            "facility_hk": hash_key("cnes_code"),
            "insurance_provider_hk": hash_key("ans_registration_number"),
        },
        derived_keys={
            "lnk_appointment_hk": link_key("appointment_hk", "patient_hk", "practitioner_hk",
                                           "facility_hk", "specialty_hk"),
            "lnk_appointment_insurance_hk": optional_link_key(
                "insurance_provider_hk", "appointment_hk", "insurance_provider_hk"),
            **({"lnk_appointment_reschedule_hk": optional_link_key(
                "rescheduled_from_hk", "appointment_hk", "rescheduled_from_hk")} if rescheduled else {}),
        },
        diffs={"hd_appointment_detail": ["scheduled_at", "created_at"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_appointment_status_history(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("appointment_id", "bigint"), "status", _c("status_at", "timestamp_ntz")],
        keys={"appointment_hk": prefixed_key(PREFIX_APPOINTMENT, F.col("appointment_id").cast("bigint"))},
        diffs={"hd_appointment_status": ["status"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_exams(
    feed: DataFrame,
    patients: DataFrame,
    exam_types: DataFrame,
    facilities: DataFrame,
    insurers: DataFrame,
    load_date: Column,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    e = keep(
        feed.join(patients.select("patient_id", "cpf"), "patient_id", "inner")
        .join(exam_types.select("exam_type_id", "tuss_code"), "exam_type_id", "inner")
        .join(facilities.select("facility_id", "cnes_code"), "facility_id", "inner")
        .join(insurers.select("insurance_provider_id", "ans_registration_number"),
              "insurance_provider_id", "left")
    )
    return stage(
        e,
        [_c("exam_id", "bigint"), _c("source_appointment_id", "bigint"),
         _c("patient_id", "bigint"), _c("exam_type_id", "bigint"),
         _c("facility_id", "bigint"), _c("scheduled_at", "timestamp_ntz"), "visit_type",
         _c("insurance_provider_id", "bigint"), "current_status",
         _c("created_at", "timestamp_ntz")],
        keys={
            "exam_hk": prefixed_key(PREFIX_EXAM, F.col("exam_id").cast("bigint")),
            "source_appointment_hk": prefixed_key(
                PREFIX_APPOINTMENT, F.col("source_appointment_id").cast("bigint")),
            "patient_hk": digits_key("cpf"),
            "exam_type_hk": hash_key("tuss_code"),
            "facility_hk": hash_key("cnes_code"),
            "insurance_provider_hk": hash_key("ans_registration_number"),
        },
        derived_keys={
            "lnk_exam_hk": link_key("exam_hk", "patient_hk", "exam_type_hk", "facility_hk",
                                    "source_appointment_hk"),
            "lnk_exam_insurance_hk": optional_link_key(
                "insurance_provider_hk", "exam_hk", "insurance_provider_hk"),
        },
        diffs={"hd_exam_detail": ["scheduled_at", "created_at"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_exam_status_history(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("exam_id", "bigint"), "status", _c("status_at", "timestamp_ntz")],
        keys={"exam_hk": prefixed_key(PREFIX_EXAM, F.col("exam_id").cast("bigint"))},
        diffs={"hd_exam_status": ["status"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_payments(feed: DataFrame, load_date: Column) -> DataFrame:
    return stage(
        feed,
        [_c("payment_id", "bigint"), "reference_type", _c("reference_id", "bigint"),
         _c("amount", "decimal(10,2)"), "payment_method", "payment_status",
         _c("paid_at", "timestamp_ntz")],
        keys={
            "payment_hk": hash_key(F.col("payment_id").cast("bigint")),
            "reference_hk": typed_reference_key("reference_type", F.col("reference_id").cast("bigint")),
            "lnk_payment_hk": raw_link_key(F.col("payment_id").cast("bigint"), "reference_type",
                                           F.col("reference_id").cast("bigint")),
        },
        diffs={"hd_payment": ["amount", "payment_method", "payment_status", "paid_at"]},
        record_source=SOURCE_CLINIC,
        load_date=load_date,
    )


def stg_patient_feedback(feed: DataFrame, load_date: Column) -> DataFrame:
    fb_hk = hash_key(F.col("feedback_id").cast("bigint"))
    pat_hk = digits_key("cpf")
    appt_hk = prefixed_key(PREFIX_APPOINTMENT, F.col("appointment_id").cast("bigint"))
    return stage(
        feed,
        [_c("feedback_id", "bigint"), _c("appointment_id", "bigint"), "cpf",
         _c("rating", "int"), "comments", _c("submitted_at", "timestamp_ntz")],
        keys={
            "feedback_hk": fb_hk,
            "appointment_hk": appt_hk,
            "patient_hk": pat_hk,
        },
        derived_keys={"lnk_feedback_hk": link_key("feedback_hk", "patient_hk", "appointment_hk")},
        diffs={"hd_feedback": ["rating", "comments"]},
        record_source=SOURCE_SURVEY,
        load_date=load_date,
    )


# -------------------------------------------------------------- intermediate


def int_appointments_rescheduled(stg_appointments: DataFrame) -> DataFrame:
    return stg_appointments.filter(F.col("rescheduled_from_hk").isNotNull())


def int_appointments_with_insurance(stg_appointments: DataFrame) -> DataFrame:
    return stg_appointments.filter(F.col("insurance_provider_hk").isNotNull())


def int_exams_with_insurance(stg_exams: DataFrame) -> DataFrame:
    return stg_exams.filter(F.col("insurance_provider_hk").isNotNull())


def int_payments_for_appointments(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.filter(F.col("reference_type") == "APPOINTMENT")


def int_payments_for_exams(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.filter(F.col("reference_type") == "EXAM")


PATIENT_UNION_COLUMNS = [
    "name", "cpf", "birth_date", "sex", "phone", "email", "address", "city", "state",
    "created_at", "patient_hk", "hd_patient", "load_date", "record_source",
]


def int_patients_unioned(stg_patients: DataFrame, stg_partner_patients: DataFrame) -> DataFrame:
    return stg_patients.select(*PATIENT_UNION_COLUMNS).unionByName(
        stg_partner_patients.select(*PATIENT_UNION_COLUMNS)
    )
