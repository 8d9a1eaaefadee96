"""Build the whole warehouse layer by layer and write every table.

Order (the model dependency graph):

1. staging     full refresh, written, then read back
2. raw vault   hubs, links, satellites: rows proven new are appended to the
               insert-only targets (rerunning the same batch appends nothing)
3. business    point-in-time table (partitioned by snapshot day; only days
               whose snapshots changed are rewritten) and bridge
4. gold        dimensions and facts
5. tests       the data-test report, a job per table
6. catalog     (optional) a database per layer, switched to the new tables

Every table is a stored table (``vaultline.sources.stored``): a full refresh is
switched by its commit, so readers of the last version are never disturbed and
a run that dies leaves it in place; a vault batch is appended once, however
often it is retried.

Each layer reads the previous layer from the written parquet, so lineage is
cut at every layer boundary: a lost executor recomputes at most the current
layer, and downstream plans start from pruned, pushed-down parquet scans.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.constants import PIT_DAYS_BACK
from vaultline.operators.checks import REPORT, reports, watched
from vaultline.plans.snapshots import refresh_pit
from vaultline.plans.vault import HUBS, LINKS, SATS, status_rank
from vaultline.plans.warehouse import Warehouse
from vaultline.sources.catalog import publish as publish_catalog
from vaultline.sources.sinks import stored_table

STAGING = [
    "stg_facilities", "stg_specialties", "stg_insurance_providers", "stg_exam_types",
    "stg_practitioners", "stg_patients", "stg_partner_patients", "stg_appointments",
    "stg_appointment_status_history", "stg_exams", "stg_exam_status_history",
    "stg_payments", "stg_patient_feedback",
]
GOLD = [
    "dim_date", "dim_patient", "dim_practitioner", "dim_facility", "dim_specialty",
    "dim_insurance_provider", "dim_exam_type", "fact_appointment", "fact_exam",
    "fact_payment", "fact_feedback",
]


REPORT_STEP = 16  # tables whose test results go into the report together


def build_warehouse(
    spark: SparkSession,
    source_root: str,
    out_root: str,
    load_date: str | None = None,
    as_of: str | None = None,
    feed_source=None,
    run_tests: bool = True,
    max_workers: int = 8,
    vault_buckets: int | None = None,
    vault_database: str = "raw_vault_parts",
    fail_on_test_failures: bool = False,
    catalog: bool = False,
    catalog_prefix: str = "",
) -> dict[str, int]:
    """Run one batch end to end; returns rows appended per vault table.

    ``vault_buckets`` stores every hub, link and satellite bucketed by its
    hash key (the parts are declared in ``vault_database``), so loads against a
    large stored vault shuffle only the incoming batch.
    ``load_date`` and ``as_of`` default to the time and day of the batch start.
    A run that is repeated, with whatever load date, appends to a vault table what
    that does not have yet (the loaders compare with what is stored).
    ``fail_on_test_failures`` raises ``DataTestFailure`` (listing the failing
    tests) when any data test fails or cannot run; the report is written either
    way, and the catalog stays as it was.
    ``catalog`` publishes the tables as views, one database per layer.
    """
    from vaultline.plans.quality import all_checks

    # One timestamp for the whole batch, taken at its start.
    now = datetime.now(timezone.utc)
    load_date = load_date or now.strftime("%Y-%m-%d %H:%M:%S")
    as_of = as_of or now.strftime("%Y-%m-%d")
    wh = Warehouse(spark, source_root, load_date=load_date, as_of=as_of, feed_source=feed_source,
                   materialize=False)
    run = uuid.uuid4().hex
    checks = all_checks()
    by_model: dict[str, list] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    seen: dict[str, dict] = {}

    def publish(name: str, layer: str, df: DataFrame) -> None:
        table = stored_table(spark, out_root, layer, name)
        seen[name] = table.replace(df, watch=watched(by_model.get(name, [])))["watched"]
        wh.overrides[name] = table.read()

    def in_parallel(fn, items) -> list:
        # Tables of one layer are independent: submit their jobs side by side.
        with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(items)))) as pool:
            return list(pool.map(fn, items))

    # The state that the stored point-in-time table shows, before it is replaced.
    snapshots = stored_table(spark, out_root, "business_vault", "pit_appointment")
    history_table = stored_table(spark, out_root, "staging", "stg_appointment_status_history")
    spine_table = stored_table(spark, out_root, "raw_vault", "hub_appointment")
    shown = (snapshots.commit() or {}).get("meta", {})
    before = None
    if history_table.available(shown.get("history")) and spine_table.available(shown.get("spine")):
        before = spine_table.read(shown["spine"]), history_table.read(shown["history"])

    if feed_source is None:
        # The order base is the input of six staging models: written once.
        publish("order_base", "staging", wh.order_facts)
        wh.order_facts = wh.overrides["order_base"]

    lookups = [n for n in STAGING if n in ("stg_appointments", "stg_exams")]
    for wave in ([n for n in STAGING if n not in lookups], lookups):
        in_parallel(lambda n: publish(n, "staging", wh.model(n)), wave)

    def new_rows(name: str) -> DataFrame:
        if name in HUBS:
            return wh.hub_new_rows(name)
        if name in LINKS:
            return wh.link_new_rows(name)
        return wh.sat_new_rows(name)

    def load_vault(name: str) -> tuple[str, int]:
        key = (HUBS.get(name) or LINKS.get(name) or SATS[name]).pk
        buckets = (key, vault_buckets, vault_database) if vault_buckets else None
        table = stored_table(spark, out_root, "raw_vault", name, buckets=buckets)
        stored = table.parts()
        if stored is not None:
            wh.targets[name] = stored
        added = table.append(new_rows(name), batch=f"{load_date}/{run}")
        table.compact()
        wh.overrides[name] = table.read()
        return name, added

    appended = dict(in_parallel(load_vault, [*HUBS, *LINKS, *SATS]))

    end = _dt.date.fromisoformat(as_of)
    refresh_pit(
        snapshots, wh.model("hub_appointment"), wh.model("stg_appointment_status_history"),
        key="appointment_hk", ts="status_at", value="status",
        start=end - _dt.timedelta(days=PIT_DAYS_BACK), end=end, before=before,
        state={"history": history_table.commit()["version"], "spine": spine_table.commit()["version"]},
        tie=[status_rank("status"), "status"], value_name="status_as_of", ts_name="sat_appointment_status_ldts")
    pit = wh.overrides["pit_appointment"] = snapshots.read()
    # Today's status comes from the written snapshot (partition pruning).
    wh.overrides["appointment_status_today"] = pit.filter(
        F.col("snapshot_date") == F.lit(as_of).cast("date")
    ).select("appointment_hk", "status_as_of", "sat_appointment_status_ldts")
    publish("bridge_encounter", "business_vault", wh.model("bridge_encounter"))

    in_parallel(lambda n: publish(n, "gold", wh.model(n)), GOLD)

    if run_tests:
        _report(spark, out_root, load_date, reports(checks, wh.model, seen, max_workers), fail_on_test_failures)
    if catalog:
        publish_catalog(spark, out_root, prefix=catalog_prefix)
    return appended


def _report(spark: SparkSession, out_root: str, run: str, found, fail: bool) -> None:
    """Append the test results table by table, as their jobs end."""
    table = stored_table(spark, out_root, "tests", "dq_report")
    held, n, bad = [], 0, []

    def put():
        nonlocal held, n
        n += 1
        rows = spark.createDataFrame(held, REPORT).select(F.lit(run).alias("run"), "*")
        # A run repeated under the same load date reports again.
        table.append(rows.coalesce(1), f"{run}/{datetime.now(timezone.utc).isoformat()}/{n}")
        held = []

    pending = 0
    for _, rows in found:
        held += rows
        pending += 1
        bad += [r for r in rows if r[3] is None or r[3] > 0]
        if pending == REPORT_STEP:
            put()
            pending = 0
    if held:
        put()
    table.compact()
    if fail and bad:
        raise DataTestFailure("data tests failed:\n" + "\n".join(
            f"{m}.{c} {t}: {'could not run' if f is None else f}" for m, c, t, f in sorted(bad, key=str)))


class DataTestFailure(RuntimeError):
    """Raised by ``build_warehouse(fail_on_test_failures=True)``."""
