"""End-to-end build: rerunning a batch appends nothing; tests pass; streaming."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.constants import AS_OF, LOAD_DATE_1, LOAD_DATE_2
from vaultline.operators.loaders import sat_rows
from vaultline.plans.build import build_warehouse
from vaultline.sources.sinks import read_table, stored_table
from vaultline.plans.vault import SATS, status_rank
from vaultline.plans.warehouse import Warehouse
from vaultline.streaming.incremental import landing_stream, vault_stream


@pytest.mark.parametrize("buckets", [None, 4])
def test_build_twice_appends_nothing(spark, tmpdir_path, buckets):
    out = os.path.join(tmpdir_path, "wh")
    db = f"vault_test_{os.path.basename(tmpdir_path).replace('-', '_')}"
    first = build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_1, as_of=AS_OF, vault_buckets=buckets, vault_database=db)
    assert first["hub_patient"] > 0 and first["sat_appointment_status"] > 0
    if buckets:
        # A new application declares the stored parts again.
        for t in spark.catalog.listTables(db):
            if not t.isTemporary:
                spark.sql(f"DROP TABLE {db}.{t.name}")
    second = build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_2, as_of=AS_OF,
                             vault_buckets=buckets, vault_database=db)
    assert set(second.values()) == {0}
    report = read_table(spark, os.path.join(out, "tests", "dq_report"))
    assert sorted(map(tuple, report.groupBy("run").count().collect())) == [(LOAD_DATE_1, 142), (LOAD_DATE_2, 142)]
    assert report.filter("failures > 0 OR failures IS NULL").count() == 0
    # The unchanged point-in-time table was not written again.
    snapshots = stored_table(spark, out, "business_vault", "pit_appointment")
    assert snapshots.versions() == [1]
    assert snapshots.read().count() == Warehouse(spark, SF_SMALL).model("pit_appointment").count()


def test_a_run_repeated_with_more_rows_appends_them(spark, tmpdir_path):
    """The same load date again, after the sources got rows that were missing."""
    base = Warehouse(spark, SF_SMALL, materialize=False)
    out = os.path.join(tmpdir_path, "wh")
    late = lambda n: base.feed(n).filter("exam_id % 3 <> 0") if n in ("exams", "exam_status_history") else base.feed(n)
    first = build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_1, as_of=AS_OF, feed_source=late, run_tests=False)
    again = build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_1, as_of=AS_OF, feed_source=base.feed, run_tests=False)
    exams = base.feed("exams").count()
    assert 0 < again["hub_exam"] == exams - first["hub_exam"] and again["hub_patient"] == 0
    assert read_table(spark, os.path.join(out, "raw_vault", "hub_exam")).count() == exams
    assert read_table(spark, os.path.join(out, "gold", "fact_exam")).count() == exams


def test_streamed_event_satellite_equals_batch_load(spark, tmpdir_path):
    wh = Warehouse(spark, SF_SMALL)
    spec = SATS["sat_appointment_status"]
    hist = wh.stg_appointment_status_history.select(
        spec.pk, spec.hashdiff, *spec.payload, spec.ldts, "record_source")
    landing = os.path.join(tmpdir_path, "landing")
    hist.filter(F.col("status_at") < "1998-01-01").write.parquet(os.path.join(landing, "b1"))
    hist.write.parquet(os.path.join(landing, "b2"))
    target = os.path.join(tmpdir_path, "sat")
    stream = landing_stream(spark, landing + "/*", hist.schema.simpleString()[7:-1].replace(":", " "),
                            max_files_per_trigger=1)
    q = vault_stream(stream, sat_rows, target, os.path.join(tmpdir_path, "ckpt"),
                     pk=spec.pk, hashdiff=spec.hashdiff, payload=list(spec.payload),
                     ldts=spec.ldts, tie=lambda: status_rank("status"))
    q.awaitTermination(300)
    got = read_table(spark, target)
    expect = wh.model("sat_appointment_status")
    assert got.count() == expect.count()
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


def test_sql_over_registered_views(spark):
    """The source project's own sanity queries run as SQL over the views."""
    wh = Warehouse(spark, SF_SMALL)
    names = wh.register_views()
    assert "fact_appointment" in names and "sat_patient" in names
    revenue = spark.sql("""
        SELECT f.name AS facility, SUM(fa.amount_paid) AS revenue
        FROM fact_appointment fa
        JOIN dim_facility f ON f.facility_hk = fa.facility_hk
        WHERE fa.visit_type = 'SELF_PAY'
        GROUP BY f.name
        ORDER BY revenue DESC""")
    assert sorted(map(tuple, revenue.collect())) == sorted(
        map(tuple, wh.q_revenue_by_facility().collect()))
    multi = spark.sql("""
        SELECT patient_hk, count(distinct record_source) AS source_count
        FROM sat_patient GROUP BY patient_hk
        HAVING count(distinct record_source) > 1""")
    assert multi.count() == wh.q_multi_source().count() > 0
    history = spark.sql("""
        SELECT * FROM sat_appointment_status
        WHERE appointment_hk = (SELECT min(appointment_hk) FROM hub_appointment)
        ORDER BY status_at""")
    assert history.count() >= 1


def test_bronze_csv_feeds_give_the_same_warehouse(spark, tmpdir_path):
    """All 13 feeds written as dated CSV extracts and read back with the
    explicit feed schemas produce the same models as the parquet binding."""
    from vaultline.sources.feeds import FEED_SCHEMAS, scan_feed, write_extract

    base = Warehouse(spark, SF_SMALL, materialize=False)
    landing = os.path.join(tmpdir_path, "bronze")
    for name in FEED_SCHEMAS:
        write_extract(base.feed(name), landing, name, "2024-02-01")
    from_csv = Warehouse(spark, SF_SMALL, feed_source=lambda n: scan_feed(spark, landing, n))
    direct = Warehouse(spark, SF_SMALL)
    for model in ("stg_appointments", "stg_payments", "sat_patient", "sat_appointment_status",
                  "bridge_encounter", "fact_appointment", "dim_patient"):
        a, b = from_csv.model(model), direct.model(model)
        assert a.count() == b.count() > 0, model
        assert a.exceptAll(b.select(*a.columns)).count() == 0, model


def test_build_can_fail_on_data_test_failures(spark, tmpdir_path):
    from vaultline.plans.build import DataTestFailure

    def feeds(name):
        base = Warehouse(spark, SF_SMALL, materialize=False).feed(name)
        if name == "patients":  # a duplicated patient breaks two unique tests
            return base.unionByName(base.limit(1))
        return base

    out = os.path.join(tmpdir_path, "wh")
    with pytest.raises(DataTestFailure, match="stg_patients.patient_id unique"):
        build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_1, as_of=AS_OF, feed_source=feeds, fail_on_test_failures=True)
    report = read_table(spark, os.path.join(out, "tests", "dq_report"))
    assert report.filter("failures > 0").count() >= 1
