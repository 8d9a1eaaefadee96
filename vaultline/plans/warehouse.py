"""The model graph: staging -> raw vault -> business vault -> star schema.

``Warehouse.model(name)`` returns any model as a DataFrame
(``"stg_appointments"``, ``"hub_patient"``, ``"fact_appointment"`` ...).

What staging has to compute with joins is written once per ``Warehouse`` as
parquet under ``spark.checkpoint.dir`` and read back: the shared order base, and
the feeds of appointments and exams with their looked-up keys (``prepare``
writes independent ones concurrently). A query that reads one of them in a single
place names it in ``once``: it is then part of the query's plan, which computes
the columns that the query reads and no others. Hash keys are no part of it: a key is
64 incompressible characters, up to eleven a row, and follows from the row's
ids, so the staging models are projections over those tables and the sources
that derive only the keys a query reads. Feeds that are given from outside
(CSV) are written as they come, without their keys.
``vaultline.plans.build.build_warehouse`` goes further and writes every
layer. ``materialize=False`` gives fully lazy plans, e.g. for ``explain``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.constants import AS_OF, LOAD_DATE_1, PIT_DAYS_BACK, PREFIX_APPOINTMENT, PREFIX_EXAM, SOURCE_CLINIC
from vaultline.functions.dates import date_key, ntz
from vaultline.functions.keys import hash_key, pack_key, prefixed_key, unpack_key
from vaultline.operators.asof import asof_day, pit
from vaultline.operators.bridge import left_chain
from vaultline.operators.calendar import calendar, calendar_window
from vaultline.operators.loaders import hub_rows, link_rows, sat_rows
from vaultline.operators.survive import source_rank, survive
from vaultline.plans import staging as S
from vaultline.plans.vault import HUBS, LINKS, SATS, status_rank
from vaultline.session import checkpoint_root, scratch_folder, scratch_path
from vaultline.sources import driver_feeds as feeds
from vaultline.sources.sinks import delete
from vaultline.sources.stored import CODEC
from vaultline.sources.tables import Tables


STAGING_MODELS = frozenset({
    "stg_facilities", "stg_specialties", "stg_insurance_providers", "stg_exam_types",
    "stg_practitioners", "stg_patients", "stg_partner_patients", "stg_appointments",
    "stg_appointment_status_history", "stg_exams", "stg_exam_status_history",
    "stg_payments", "stg_patient_feedback",
})


# Staging models whose feeds derive from the shared order base.
ORDER_STAGING = frozenset({
    "stg_appointments", "stg_appointment_status_history", "stg_exams",
    "stg_exam_status_history", "stg_payments", "stg_patient_feedback",
})
# Staging models that look up other staging models (hub keys by internal id).
LOOKUP_STAGING = {
    "stg_appointments": ("stg_patients", "stg_practitioners", "stg_facilities",
                         "stg_insurance_providers"),
    "stg_exams": ("stg_patients", "stg_exam_types", "stg_facilities", "stg_insurance_providers"),
}
# Hub keys that are hashes of one id alone: (the id's column, key from id).
ID_KEYS: dict[str, tuple[str, Callable[[str], Column]]] = {
    "appointment_hk": ("appointment_id", partial(prefixed_key, PREFIX_APPOINTMENT)),
    "source_appointment_hk": ("source_appointment_id", partial(prefixed_key, PREFIX_APPOINTMENT)),
    "specialty_hk": ("specialty_id", hash_key),
    "exam_hk": ("exam_id", partial(prefixed_key, PREFIX_EXAM)),
    "payment_hk": ("payment_id", hash_key),
    # Of payments of one reference type.
    "reference_hk": ("reference_id", lambda c: F.col(c)),
    "feedback_hk": ("feedback_id", hash_key),
}
# Direct model dependencies above staging (the model graph).
MODEL_DEPS = {
    "int_appointments_rescheduled": ("stg_appointments",),
    "int_appointments_with_insurance": ("stg_appointments",),
    "int_exams_with_insurance": ("stg_exams",),
    "int_payments_for_appointments": ("stg_payments",),
    "int_payments_for_exams": ("stg_payments",),
    "int_patients_unioned": ("stg_patients", "stg_partner_patients"),
    "pit_appointment": ("hub_appointment", "stg_appointment_status_history"),
    "appointment_status_today": ("hub_appointment", "stg_appointment_status_history"),
    "bridge_encounter": ("lnk_appointment", "lnk_appointment_insurance", "lnk_exam",
                         "lnk_payment_appointment", "lnk_payment_exam", "lnk_feedback"),
    "dim_patient": ("sat_patient", "hub_patient"),
    "dim_practitioner": ("stg_practitioners",),
    "dim_facility": ("stg_facilities",),
    "dim_specialty": ("stg_specialties",),
    "dim_insurance_provider": ("stg_insurance_providers",),
    "dim_exam_type": ("stg_exam_types",),
    "dim_date": ("stg_appointments", "stg_exams", "stg_payments", "stg_patient_feedback"),
    "dim_date_window": ("stg_appointments",),
    "fact_appointment": ("stg_appointments", "appointment_status_today", "bridge_encounter",
                         "stg_payments", "stg_patient_feedback"),
    "fact_exam": ("stg_exams", "lnk_payment_exam", "stg_payments"),
    "fact_payment": ("stg_payments",),
    "fact_feedback": ("stg_patient_feedback",),
}


def read_once(*names: str) -> frozenset[str]:
    """Of what ``prepare`` would write for these models, what only one of them
    reads, and in one place."""
    def reads(name: str) -> list[str]:
        if name in STAGING_MODELS:
            return [name]
        specs = {**HUBS, **LINKS, **SATS}
        if name in HUBS:
            deps = HUBS[name].sources
        else:
            deps = (specs[name].source,) if name in specs else MODEL_DEPS.get(name, ())
        return [r for d in deps for r in reads(d)]

    read = [r for n in names for r in reads(n)]
    from_orders = [r for r in read if r in ORDER_STAGING]
    once = {m for m in LOOKUP_STAGING if read.count(m) == 1}
    return frozenset(once | ({"order_facts"} if len(from_orders) == 1 and set(from_orders) <= once else set()))


def reads_rescheduled(*names: str) -> bool:
    """Whether one of these models has, or is made from, the columns of the
    rescheduled link (a model that returns whole appointment rows has them)."""
    return bool(set(names) & {"stg_appointments", "int_appointments_rescheduled",
                              "int_appointments_with_insurance", "lnk_appointment_reschedule"})


def staging_needs(name: str) -> set[str]:
    """Staging models ``name`` reads, directly or through other models."""
    if name in STAGING_MODELS:
        return {name, *LOOKUP_STAGING.get(name, ())}
    if name in HUBS:
        deps = HUBS[name].sources
    elif name in LINKS:
        deps = (LINKS[name].source,)
    elif name in SATS:
        deps = (SATS[name].source,)
    else:
        deps = MODEL_DEPS.get(name, ())
    out: set[str] = set()
    for d in deps:
        out |= staging_needs(d)
    return out


class Warehouse:
    """All models over one set of feeds.

    ``feed_source`` maps a feed name to a DataFrame; by default the feeds are
    derived from the driver tables under ``root`` (``driver_feeds``).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        load_date: str = LOAD_DATE_1,
        as_of: str = AS_OF,
        feed_source=None,
        targets: dict[str, DataFrame | list[DataFrame]] | None = None,
        materialize: bool = True,
        once: frozenset[str] = frozenset(),
        rescheduled: bool = True,
        deal: dict[str, str] | None = None,
    ):
        self.spark = spark
        # Staging tables (and "order_facts") that are read in one place: not written.
        # The order base is read twice where rescheduled appointments are found.
        self.once = frozenset(once) - ({"order_facts"} if rescheduled else set())
        # Tables of ``once`` to be dealt out by an id, before their keys are derived.
        self.deal = {m: c for m, c in (deal or {}).items() if m in self.once}
        # False: appointments come without the columns of the rescheduled link.
        self.rescheduled = rescheduled
        # The joins of the staging layer are written once as parquet under
        # spark.checkpoint.dir and read back, so downstream models neither
        # recompute them nor carry their lineage.
        self.materialize = materialize
        self.materialize_models: frozenset[str] = STAGING_MODELS
        self.run_id = uuid.uuid4().hex
        if materialize:
            checkpoint_root(spark)
            scratch_folder(spark, "tables", self.run_id)
        self.root = root
        self.tables = Tables(spark, root)
        self.load_date_text = load_date
        self.load_date: Column = ntz(load_date)
        self.as_of = as_of
        self._feed_source = feed_source
        # Stored hub/link/satellite tables (incremental targets), if any.
        self.targets = targets or {}
        # Models read from written tables instead of being derived here.
        self.overrides: dict[str, DataFrame] = {}

    # ------------------------------------------------------------ feeds

    @cached_property
    def order_facts(self) -> DataFrame:
        facts = feeds.order_facts(self.tables)
        return facts if "order_facts" in self.once else self._materialized(facts)

    def _materialized(self, df: DataFrame, name: str = "order_facts") -> DataFrame:
        """Write ``df`` once as parquet under the shared checkpoint folder and
        read it back (pruning and filter pushdown apply to the read)."""
        if not self.materialize:
            return df
        path = scratch_path(self.spark, "tables", self.run_id, name)
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.parquet(path)

    def _kept(self, model: str) -> Callable[[DataFrame], DataFrame]:
        """Writes a staging model's rows before their keys are derived."""
        if model in self.materialize_models and model not in self.once:
            return lambda df: self._materialized(df, model)
        if model in self.deal:
            return lambda df: df.repartition(self.deal[model])
        return lambda df: df

    def _staging_feed(self, name: str, model: str) -> DataFrame:
        """A feed to be read by several models: written unless it is a projection
        of driver tables or of the order base."""
        df = self.feed(name)
        if self._feed_source is not None or model == "stg_insurance_providers":
            return self._kept(model)(df)
        return df

    def feed(self, name: str) -> DataFrame:
        if self._feed_source is not None:
            return self._feed_source(name)
        fn = getattr(feeds, name)
        if name == "appointments":
            return fn(self.tables, self.order_facts, rescheduled=self.rescheduled)
        if name in {"appointment_status_history", "exams", "exam_status_history", "payments",
                    "patient_feedback"}:
            return fn(self.tables, self.order_facts)
        return fn(self.tables)

    # ---------------------------------------------------------- staging

    @cached_property
    def stg_facilities(self):
        return S.stg_facilities(self._staging_feed("facilities", "stg_facilities"), self.load_date)

    @cached_property
    def stg_specialties(self):
        return S.stg_specialties(self._staging_feed("specialties", "stg_specialties"), self.load_date)

    @cached_property
    def stg_insurance_providers(self):
        return S.stg_insurance_providers(self._staging_feed("insurance_providers", "stg_insurance_providers"), self.load_date)

    @cached_property
    def stg_exam_types(self):
        return S.stg_exam_types(self._staging_feed("exam_types", "stg_exam_types"), self.load_date)

    @cached_property
    def stg_practitioners(self):
        return S.stg_practitioners(self._staging_feed("practitioners", "stg_practitioners"), self.load_date)

    @cached_property
    def stg_patients(self):
        return S.stg_patients(self._staging_feed("patients", "stg_patients"), self.load_date)

    @cached_property
    def stg_partner_patients(self):
        return S.stg_partner_patients(self._staging_feed("partner_patients", "stg_partner_patients"), self.load_date)

    @cached_property
    def stg_appointments(self):
        return S.stg_appointments(
            self.feed("appointments"), self.model("stg_patients"), self.model("stg_practitioners"),
            self.model("stg_facilities"), self.model("stg_insurance_providers"), self.load_date,
            keep=self._kept("stg_appointments"), rescheduled=self.rescheduled)

    @cached_property
    def stg_appointment_status_history(self):
        return S.stg_appointment_status_history(
            self._staging_feed("appointment_status_history", "stg_appointment_status_history"), self.load_date)

    @cached_property
    def stg_exams(self):
        return S.stg_exams(
            self.feed("exams"), self.model("stg_patients"), self.model("stg_exam_types"),
            self.model("stg_facilities"), self.model("stg_insurance_providers"), self.load_date,
            keep=self._kept("stg_exams"))

    @cached_property
    def stg_exam_status_history(self):
        return S.stg_exam_status_history(self._staging_feed("exam_status_history", "stg_exam_status_history"), self.load_date)

    @cached_property
    def stg_payments(self):
        return S.stg_payments(self._staging_feed("payments", "stg_payments"), self.load_date)

    @cached_property
    def stg_patient_feedback(self):
        return S.stg_patient_feedback(self._staging_feed("patient_feedback", "stg_patient_feedback"), self.load_date)

    # ----------------------------------------------------- intermediate

    @cached_property
    def int_appointments_rescheduled(self):
        return S.int_appointments_rescheduled(self.model("stg_appointments"))

    @cached_property
    def int_appointments_with_insurance(self):
        return S.int_appointments_with_insurance(self.model("stg_appointments"))

    @cached_property
    def int_exams_with_insurance(self):
        return S.int_exams_with_insurance(self.model("stg_exams"))

    @cached_property
    def int_payments_for_appointments(self):
        return S.int_payments_for_appointments(self.model("stg_payments"))

    @cached_property
    def int_payments_for_exams(self):
        return S.int_payments_for_exams(self.model("stg_payments"))

    @cached_property
    def int_patients_unioned(self):
        return S.int_patients_unioned(self.model("stg_patients"), self.model("stg_partner_patients"))

    # -------------------------------------------------------- raw vault

    def hub_new_rows(self, name: str) -> DataFrame:
        spec = HUBS[name]
        return hub_rows([self.model(s) for s in spec.sources], spec.pk, spec.nk,
                        ldts=spec.ldts, existing=self.targets.get(name))

    def appointment_ids(self) -> DataFrame:
        """The ids in the appointment hub.  Its key is a hash of the id alone, so
        the status history is resolved by id and the key derived afterwards."""
        name, spec = "hub_appointment", HUBS["hub_appointment"]
        if name in self.overrides or name in self.targets:
            return self.model(name).select(spec.nk)
        return hub_rows([self.model(x) for x in spec.sources], spec.pk, spec.nk, ldts=spec.ldts,
                        by_natural_key=True).select(spec.nk)

    def link_new_rows(self, name: str) -> DataFrame:
        spec = LINKS[name]
        # A staged link key follows from its hub keys, so rows of one link key
        # have the same ones, and none has to be ordered by them.
        return link_rows(self.model(spec.source), spec.pk, list(spec.fks),
                         ldts=spec.ldts, existing=self.targets.get(name), tie=(),
                         within=spec.by if spec.by and self.deal.get(spec.source) == spec.by else None)

    @property
    def _by_id(self) -> bool:
        """Whether appointments and what is linked to them can be joined by id: not
        where a link is given as a table, which has hash keys only."""
        given = {*self.overrides, *self.targets}
        return not given & {*MODEL_DEPS["bridge_encounter"], "appointment_status_today"}

    def _narrow(self, key: str) -> Column:
        """A hub key as it is moved: the id that it hashes, or else its bytes."""
        return F.col(ID_KEYS[key][0]) if self._by_id and key in ID_KEYS else pack_key(key)

    def _wide(self, key: str, column: str | None = None) -> Column:
        """The text of a key that ``_narrow`` gave, held in ``column``."""
        column = column or key
        return ID_KEYS[key][1](column) if self._by_id and key in ID_KEYS else unpack_key(column)

    def _narrow_link(self, name: str, by: str) -> DataFrame:
        """The hub keys of a link as they are moved, dealt out by one of them."""
        spec = LINKS[name]
        if name in self.overrides or name in self.targets:
            stored = self.model(name)
            return stored.select(*[pack_key(c).alias(c) for c in spec.fks if c in stored.columns])
        return link_rows(self.model(spec.source), spec.pk, list(spec.fks), ldts=spec.ldts, by=by,
                         as_key=self._narrow if self._by_id else pack_key)

    def sat_new_rows(self, name: str, bucket=None) -> DataFrame:
        spec = SATS[name]
        tie = (lambda: status_rank("status")) if spec.event_time else None
        # Status histories are bounded per key by the status lifecycle (a few
        # transitions), so one window per key is safe here; unbounded
        # per-key histories (event streams) pass ``bucket`` (see scenarios).
        return sat_rows(self.model(spec.source), spec.pk, spec.hashdiff, list(spec.payload),
                        ldts=spec.ldts, existing=self.targets.get(name), tie=tie, bucket=bucket)

    def vault_table(self, name: str) -> DataFrame:
        """Target state after this batch: stored rows plus the rows to append."""
        if name in HUBS:
            new = self.hub_new_rows(name)
        elif name in LINKS:
            new = self.link_new_rows(name)
        else:
            new = self.sat_new_rows(name)
        stored = self.targets.get(name)
        if stored is None:
            return new
        for part in stored if isinstance(stored, list) else [stored]:
            new = part.unionByName(new)
        return new

    # -------------------------------------------------- business vault

    def pit_appointment(self, days_back: int = PIT_DAYS_BACK, bucket: Column | None = None) -> DataFrame:
        end = _dt.date.fromisoformat(self.as_of)
        start = end - _dt.timedelta(days=days_back)
        return pit(
            self.appointment_ids(),
            self.model("stg_appointment_status_history"),
            key="appointment_id", ts="status_at", values=["status"],
            start=start, end=end, tie=[status_rank("status"), "status"],
            value_names=["status_as_of"], ts_name="sat_appointment_status_ldts",
            bucket=bucket, key_as=prefixed_key(PREFIX_APPOINTMENT, "appointment_id"),
        ).withColumnRenamed("appointment_id", "appointment_hk")

    @cached_property
    def appointment_status_today(self) -> DataFrame:
        """The PIT row of the as-of day, computed directly (one aggregate)."""
        return self._status_today_by_id().select(prefixed_key(PREFIX_APPOINTMENT, "appointment_id").alias("appointment_hk"),
                          "status_as_of", "sat_appointment_status_ldts")

    def _status_today_by_id(self) -> DataFrame:
        return asof_day(
            self.appointment_ids(),
            self.model("stg_appointment_status_history"),
            key="appointment_id", ts="status_at", values=["status"], day=self.as_of,
            tie=[status_rank("status"), "status"],
            value_names=["status_as_of"], ts_name="sat_appointment_status_ldts",
        )

    def _encounters(self, details: bool) -> DataFrame:
        """One row per appointment and what is linked to it.  Every side is
        completed on its own key first, so the chain is joined on
        ``appointment_hk`` alone.  ``details`` adds the payment's and the
        feedback's own columns.  Keys are as they are moved (``_narrow``)."""
        m, link = self.model, self._narrow_link
        base = link("lnk_appointment", "appointment_hk")
        insurer = link("lnk_appointment_insurance", "appointment_hk").select(
            "appointment_hk", F.col("insurance_provider_hk").alias("appointment_insurance_provider_hk"))
        exam_payment = link("lnk_payment_exam", "reference_hk").select(
            F.col("reference_hk").alias("exam_hk"), F.col("payment_hk").alias("exam_payment_hk"))
        exam = link("lnk_exam", "exam_hk").select(
            F.col("source_appointment_hk").alias("appointment_hk"), "exam_hk", "exam_type_hk",
        ).join(exam_payment, "exam_hk", "left")
        payment = link("lnk_payment_appointment", "payment_hk" if details else "reference_hk").select(
            F.col("reference_hk").alias("appointment_hk"), F.col("payment_hk").alias("appointment_payment_hk"))
        feedback = link("lnk_feedback", "feedback_hk" if details else "appointment_hk").select(
            "appointment_hk", "feedback_hk")
        if details:
            payment = payment.join(
                m("stg_payments").select(self._narrow("payment_hk").alias("appointment_payment_hk"), "amount",
                                         "payment_method", "payment_status"),
                "appointment_payment_hk", "left")
            feedback = feedback.join(
                m("stg_patient_feedback").select(
                    self._narrow("feedback_hk").alias("feedback_hk"), F.col("rating").alias("feedback_rating")),
                "feedback_hk", "left")
        return left_chain(base, "appointment_hk", [insurer, exam, payment, feedback])

    @cached_property
    def bridge_encounter(self) -> DataFrame:
        of = {"appointment_insurance_provider_hk": "insurance_provider_hk",
              "appointment_payment_hk": "payment_hk", "exam_payment_hk": "payment_hk"}
        return self._encounters(details=False).select(*[self._wide(of.get(c, c), c).alias(c) for c in (
            "appointment_hk", "patient_hk", "practitioner_hk", "facility_hk", "specialty_hk",
            "appointment_insurance_provider_hk", "exam_hk", "exam_type_hk",
            "appointment_payment_hk", "exam_payment_hk", "feedback_hk",
        )])

    # ---------------------------------------------------------- gold

    @cached_property
    def dim_patient(self) -> DataFrame:
        sat = self.model("sat_patient")
        golden = survive(
            sat, "patient_hk",
            [source_rank("record_source", [SOURCE_CLINIC]), F.col("load_date").desc(),
             F.col("hd_patient")],
        )
        hub = self.model("hub_patient").select("patient_hk")
        return hub.join(golden, "patient_hk", "inner").select(
            "patient_hk", "name", "cpf", "birth_date", "sex", "phone", "email",
            "address", "city", "state", F.col("record_source").alias("golden_record_source"))

    @cached_property
    def dim_practitioner(self):
        return self.model("stg_practitioners").select(
            "practitioner_hk", "practitioner_id", "name", "license_number",
            "specialty_id", "facility_id", "phone", "email")

    @cached_property
    def dim_facility(self):
        return self.model("stg_facilities").select(
            "facility_hk", "facility_id", "cnes_code", "name", "address", "city", "state", "phone")

    @cached_property
    def dim_specialty(self):
        return self.model("stg_specialties").select("specialty_hk", "specialty_id", "name")

    @cached_property
    def dim_insurance_provider(self):
        return self.model("stg_insurance_providers").select(
            "insurance_provider_hk", "insurance_provider_id", "name", "ans_registration_number")

    @cached_property
    def dim_exam_type(self):
        return self.model("stg_exam_types").select(
            "exam_type_hk", "exam_type_id", "tuss_code", "name", "category", "self_pay_price")

    @cached_property
    def dim_date_window(self) -> DataFrame:
        """Calendar from 730 days before to 365 days after the current day,
        which for these tables is the day of the latest appointment."""
        today = self.model("stg_appointments").agg(F.max(F.to_date("scheduled_at")).alias("today"))
        return calendar_window(today, "today")

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar spanning every date the facts refer to."""
        dates = (
            self.model("stg_appointments").select(F.to_date("scheduled_at").alias("d"))
            .unionByName(self.model("stg_exams").select(F.to_date("scheduled_at").alias("d")))
            .unionByName(self.model("stg_payments").select(F.to_date("paid_at").alias("d")))
            .unionByName(self.model("stg_patient_feedback").select(F.to_date("submitted_at").alias("d")))
        )
        return calendar(dates.agg(F.min("d").alias("start"), F.max("d").alias("end")))

    @cached_property
    def fact_appointment(self) -> DataFrame:
        keys = ("appointment_hk", "patient_hk", "practitioner_hk", "facility_hk", "specialty_hk",
                "insurance_provider_hk")
        a = self.model("stg_appointments").select(
            "appointment_id", *[self._narrow(c).alias(c) for c in keys], "scheduled_at", "visit_type", "current_status")
        if self._by_id:
            ts = self._status_today_by_id().select(F.col("appointment_id").alias("appointment_hk"), "status_as_of")
        else:
            ts = self.model("appointment_status_today").select(
                pack_key("appointment_hk").alias("appointment_hk"), "status_as_of")
        links = self._encounters(details=True).select(
            "appointment_hk", F.col("exam_hk").alias("b_exam_hk"), F.col("exam_type_hk").alias("b_exam_type_hk"),
            F.col("feedback_hk").alias("b_feedback_hk"), "amount", "payment_method", "payment_status",
            "feedback_rating")
        j = left_chain(a, "appointment_hk", [ts, links])
        return j.select(
            "appointment_id", *[self._wide(c).alias(c) for c in keys],
            self._wide("exam_hk", "b_exam_hk").alias("exam_hk"),
            self._wide("exam_type_hk", "b_exam_type_hk").alias("exam_type_hk"),
            self._wide("feedback_hk", "b_feedback_hk").alias("feedback_hk"),
            date_key("scheduled_at").alias("scheduled_date_key"),
            "visit_type",
            F.coalesce(F.col("status_as_of"), F.col("current_status")).alias("current_status"),
            F.col("amount").alias("amount_paid"), "payment_method", "payment_status",
            "feedback_rating",
            F.col("b_exam_hk").isNotNull().alias("has_exam"),
            F.col("b_feedback_hk").isNotNull().alias("has_feedback"),
            F.lit(1).alias("appointment_count"),
        )

    @cached_property
    def fact_exam(self) -> DataFrame:
        e = self.model("stg_exams")
        pl = self.model("lnk_payment_exam").select(
            "payment_hk", F.col("reference_hk").alias("exam_hk"))
        p = self.model("stg_payments").select("payment_hk", "amount", "payment_method", "payment_status")
        # Payments meet their link on the small side; the fact is joined once.
        j = e.join(pl.join(p, "payment_hk", "left"), "exam_hk", "left")
        return j.select(
            "exam_id", "exam_hk", F.col("source_appointment_hk").alias("appointment_hk"),
            "patient_hk", "facility_hk", "exam_type_hk", "insurance_provider_hk",
            date_key("scheduled_at").alias("scheduled_date_key"), "visit_type",
            "current_status", F.col("amount").alias("amount_paid"), "payment_method",
            "payment_status", F.lit(1).alias("exam_count"),
        )

    @cached_property
    def fact_payment(self) -> DataFrame:
        return self.model("stg_payments").select(
            "payment_id", "payment_hk", "reference_type", "reference_hk", "amount",
            "payment_method", "payment_status", date_key("paid_at").alias("paid_date_key"))

    @cached_property
    def fact_feedback(self) -> DataFrame:
        return self.model("stg_patient_feedback").select(
            "feedback_id", "feedback_hk", "appointment_hk", "patient_hk", "rating", "comments",
            date_key("submitted_at").alias("submitted_date_key"))

    # ------------------------------------------------ analytic queries

    def q_multi_source(self) -> DataFrame:
        return (
            self.model("sat_patient").groupBy("patient_hk")
            .agg(F.countDistinct("record_source").alias("source_count"))
            .filter(F.col("source_count") > 1)
        )

    def q_status_history(self) -> DataFrame:
        first = self.model("hub_appointment").agg(F.min("appointment_hk")).scalar()
        return (
            self.model("sat_appointment_status")
            .filter(F.col("appointment_hk") == first)
            .orderBy("status_at", "status")
        )

    def q_revenue_by_facility(self) -> DataFrame:
        fa = self.model("fact_appointment").filter(F.col("visit_type") == "SELF_PAY")
        f = self.model("dim_facility").select("facility_hk", F.col("name").alias("facility"))
        return (
            fa.join(f, "facility_hk", "inner")
            .groupBy("facility")
            .agg(F.sum("amount_paid").alias("revenue"))
            .orderBy(F.col("revenue").desc())
        )

    # --------------------------------------------------------- lookup

    def register_views(self, names=None) -> list[str]:
        """Expose models as temporary views for SQL users (``spark.sql``).

        Views are lazy: a SQL query over them is planned by Catalyst together
        with the models it reads.  Defaults to every staging, vault, business
        and gold model.
        """
        if names is None:
            names = [*STAGING_MODELS, *MODEL_DEPS, *HUBS, *LINKS, *SATS]
        names = [n for n in dict.fromkeys(names) if n != "appointment_status_today"]
        self.prepare(*names)
        for n in names:
            self.model(n).createOrReplaceTempView(n)
        return names

    def cleanup(self) -> None:
        """Delete this run's written staging tables (after its results are used)."""
        if not self.materialize:
            return
        delete(self.spark, scratch_path(self.spark, "tables", self.run_id))
        for name in self._staged:
            self.__dict__.pop(name, None)
        self._staged.clear()
        self.__dict__.pop("order_facts", None)

    def prepare(self, *names: str) -> None:
        """Write the staging tables that ``names`` need, independent ones
        concurrently (Spark runs jobs submitted from several threads side by
        side): first the order base together with the master-data staging,
        then the staging models derived from orders (which look up master
        data)."""
        if not self.materialize:
            return
        need: set[str] = set()
        for n in names:
            need |= staging_needs(n)
        need = {n for n in need if n in self.materialize_models and n not in self._staged}
        if not need:
            return
        from_orders = need & ORDER_STAGING
        first: list = sorted(need - from_orders)
        if from_orders and self._feed_source is None and "order_facts" not in self.__dict__:
            first.append("order_facts")

        def write(name: str) -> None:
            if name == "order_facts":
                self.order_facts  # noqa: B018 - cached property writes it
            else:
                self.model(name)

        for wave in (first, sorted(from_orders)):
            if wave:
                with ThreadPoolExecutor(max_workers=max(1, min(8, len(wave)))) as pool:
                    list(pool.map(write, wave))

    def model(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        if name in HUBS or name in LINKS or name in SATS:
            return self._vault(name)
        if name == "pit_appointment":
            return self.pit_appointment()
        if name in STAGING_MODELS and name in self.materialize_models:
            if name not in self._staged:
                self._staged[name] = getattr(self, name)
            return self._staged[name]
        return getattr(self, name)

    @cached_property
    def _vault_cache(self) -> dict[str, DataFrame]:
        return {}

    @cached_property
    def _staged(self) -> dict[str, DataFrame]:
        return {}

    def _vault(self, name: str) -> DataFrame:
        if name not in self._vault_cache:
            self._vault_cache[name] = self.vault_table(name)
        return self._vault_cache[name]
