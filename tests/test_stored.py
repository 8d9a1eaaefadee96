"""Stored tables: switched versions, batches, partitions, parts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.operators.loaders import hub_rows
from vaultline.sources.stored import CommitConflict, StoredTable, _Files


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_run_killed_before_the_switch_leaves_the_old_table(spark, tmpdir_path, monkeypatch):
    t = StoredTable(spark, tmpdir_path + "/t")
    assert t.read() is None and t.commit() is None
    t.replace(spark.range(5))
    reader = t.read()

    def killed(self, file, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(_Files, "create", killed)
        with pytest.raises(KeyboardInterrupt):
            t.replace(spark.range(100, 110))  # data written, not switched
        with pytest.raises(KeyboardInterrupt):
            t.append(spark.range(3), "b")
    assert values(t.read()) == values(reader) == list(range(5))
    assert len(os.listdir(tmpdir_path + "/t/data")) == 3
    t.replace(spark.range(2))
    assert values(t.read()) == [0, 1]
    assert len(os.listdir(tmpdir_path + "/t/data")) == 2  # the orphans are gone, the last version is kept
    assert values(reader) == list(range(5))


def test_old_versions_go_after_the_grace_count(spark, tmpdir_path):
    t = StoredTable(spark, tmpdir_path + "/t", keep=1)
    for i in range(4):
        t.replace(spark.range(i))
    assert values(t.read()) == [0, 1, 2] and values(t.read(3)) == [0, 1]
    assert t.available(3) and not t.available(2) and not t.available(None)
    assert len(os.listdir(tmpdir_path + "/t/data")) == 2


def test_a_query_that_reads_its_own_target(spark, tmpdir_path):
    t = StoredTable(spark, tmpdir_path + "/t")
    t.replace(spark.range(3))
    t.replace(t.read().select((F.col("id") + 10).alias("id")))
    assert values(t.read()) == [10, 11, 12]


def test_batches_are_appended_once(spark, tmpdir_path, monkeypatch):
    t = StoredTable(spark, tmpdir_path + "/t")
    assert [t.append(spark.range(5), "b1"), t.append(spark.range(5, 7), "b2")] == [5, 2]
    with monkeypatch.context() as m:
        m.setattr(_Files, "create", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.append(spark.range(7, 9), "b3")  # dies half-way: invisible
    assert values(t.read()) == list(range(7))
    assert t.append(spark.range(7, 9), "b3") == 2  # retried
    # A batch in the log is not even evaluated again.
    assert t.append(spark.range(1).select(F.raise_error(F.lit("evaluated")).cast("long").alias("id")), "b3") == 0
    assert t.append(spark.range(0), "empty") == 0
    assert values(t.read()) == list(range(9))
    assert t.commit()["batches"] == {"b1": 5, "b2": 2, "b3": 2, "empty": 0}


def test_two_writers_of_one_version(spark, tmpdir_path):
    a, b = (StoredTable(spark, tmpdir_path + "/t") for _ in range(2))
    a.replace(spark.range(1))
    old = b.commit()
    a.replace(spark.range(2))
    b.commit = lambda version=None: old
    with pytest.raises(CommitConflict):
        b.replace(spark.range(3))
    assert values(a.read()) == [0, 1]


def test_only_the_named_partitions_change(spark, tmpdir_path):
    t = StoredTable(spark, tmpdir_path + "/t")
    day = lambda i: f"date_add(DATE'2024-01-01', CAST({i} AS INT))"
    t.replace(spark.range(6).selectExpr("id", f"{day('id % 3')} AS d"), ["d"])
    first = t.commit()["parts"]
    t.replace_partitions(spark.sql(f"SELECT 100L AS id, {day(1)} AS d"), [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 9)])
    assert sorted(map(tuple, t.read().collect())) == [(0, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 1)), (100, dt.date(2024, 1, 2))]
    assert [p for p in t.commit()["parts"] if p in first] == [p for p in first if p.endswith("2024-01-01")]
    with pytest.raises(ValueError):
        t.replace_partitions(spark.sql(f"SELECT 1L AS id, {day(0)} AS d"), [dt.date(2024, 1, 2)])
    assert t.read().filter("d = DATE'2024-01-02'").inputFiles()  # pruned by folder
    assert all("d=2024-01-02" in f for f in t.read().filter("d = DATE'2024-01-02'").inputFiles() if "d=2024-01-02" in f)


def test_parts_stay_few(spark, tmpdir_path):
    t = StoredTable(spark, tmpdir_path + "/t")
    t.append(spark.range(1000), "big")
    big = t.commit()["parts"][0]
    merged = 0
    for i in range(12):
        t.append(spark.range(1000 + 10 * i, 1010 + 10 * i), f"b{i}")
        merged += t.compact(most=4)
        assert len(t.commit()["parts"]) <= 4
    assert merged and big in t.commit()["parts"]  # the large part was never rewritten
    assert values(t.read()) == list(range(1120))
    assert len(t.commit()["batches"]) == 13


def test_bucketed_parts_join_without_a_shuffle(spark, tmpdir_path):
    from test_plans import ancestors, plan_of

    db = "stored_" + os.path.basename(tmpdir_path).replace("-", "_")
    t = StoredTable(spark, tmpdir_path + "/hub", buckets=("hk", 4, db))
    batch = lambda lo, hi: spark.range(lo, hi).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS hk", "id AS nk", "TIMESTAMP_NTZ'2024-02-01' AS load_date", "'s' AS record_source")
    for i in range(10):
        t.append(hub_rows(batch(0, 100 * (i + 1)), "hk", "nk", existing=t.parts()), f"b{i}")
        t.compact(most=3)
        parts = t.parts()
        assert len(parts) <= 3
        for p in t.commit()["parts"]:  # one file per bucket and part
            files = [f for f in os.listdir(f"{t.path}/{p}") if f.endswith(".parquet")]
            assert len(files) == len({f.split("_")[1] for f in files}) <= 4
    assert t.read().count() == 1000 and sum(p.count() for p in parts) == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(hub_rows(batch(0, 50), "hk", "nk", existing=t.parts())).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "hub_" in line]
    assert len(scans) == len(parts)
    for i in scans:  # between the join and the stored scan nothing is exchanged
        below = [line for line in ancestors(plan, i)]
        join = next(j for j, line in enumerate(below) if "Join" in line)
        assert not any("Exchange" in line for line in below[:join])
    # Another application finds the parts by the commit log alone.
    for table in spark.catalog.listTables(db):
        if not table.isTemporary:
            spark.sql(f"DROP TABLE {db}.{table.name}")
    assert sum(p.count() for p in StoredTable(spark, t.path, buckets=t.buckets).parts()) == 1000


def test_derived_columns_are_read_not_stored(spark, tmpdir_path):
    derived = lambda rows: rows.select("id", (F.col("id") * 2).alias("twice"))
    t = StoredTable(spark, tmpdir_path + "/t", derived=derived)
    assert t.read() is None and t.parts() is None
    for i in range(6):
        t.append(spark.range(10 * i, 10 * i + 10), f"b{i}")
    assert t.compact(most=2)
    assert sorted(map(tuple, t.read().collect())) == [(i, 2 * i) for i in range(60)]
    assert [p.columns for p in t.parts()] == [["id"]] and t.read(1).columns == ["id", "twice"]
    assert StoredTable(spark, t.path).read().columns == ["id"]


def test_catalog_views_follow_the_commits(spark, tmpdir_path):
    from vaultline.sources.catalog import publish
    from vaultline.sources.sinks import stored_table

    prefix = "cat_" + os.path.basename(tmpdir_path).replace("-", "_") + "_"
    gold, pit = (stored_table(spark, tmpdir_path, *n) for n in (("gold", "f"), ("business_vault", "p")))
    gold.replace(spark.range(3))
    pit.replace(spark.range(4).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS d"), ["d"])
    assert publish(spark, tmpdir_path, prefix=prefix) == [f"{prefix}business_vault.p", f"{prefix}gold.f"]
    other = spark.newSession()
    ask = lambda sql: [tuple(r) for r in other.sql(sql).collect()]
    assert ask(f"SELECT count(*) FROM {prefix}gold.f") == [(3,)]
    gold.append(spark.range(3, 5), "b")
    gold_view = f"SELECT sum(id), count(*) FROM {prefix}gold.f"
    assert ask(gold_view) == [(3, 3)]  # not published yet
    pit.replace_partitions(spark.sql("SELECT 9L AS id, DATE'2024-01-02' AS d"), ["2024-01-02"])
    gold.replace(spark.range(0), meta={})
    gold.append(spark.range(7, 8), "c")
    publish(spark, tmpdir_path, prefix=prefix)
    assert ask(gold_view) == [(7, 1)]
    assert sorted(ask(f"SELECT id, CAST(d AS STRING) FROM {prefix}business_vault.p")) == [
        (0, "2024-01-01"), (2, "2024-01-01"), (9, "2024-01-02")]
    assert ask(f"SELECT id FROM {prefix}business_vault.p WHERE d = DATE'2024-01-02'") == [(9,)]


def test_the_built_warehouse_in_the_catalog(spark, tmpdir_path):
    from vaultline.constants import AS_OF, LOAD_DATE_1
    from vaultline.plans.build import build_warehouse
    from vaultline.plans.warehouse import Warehouse

    prefix = "wh_" + os.path.basename(tmpdir_path).replace("-", "_") + "_"
    build_warehouse(spark, SF_SMALL, tmpdir_path + "/wh", load_date=LOAD_DATE_1, as_of=AS_OF, run_tests=False,
                    catalog=True, catalog_prefix=prefix)
    other = spark.newSession()
    got = other.sql(f"SELECT f.name AS facility, SUM(a.amount_paid) AS revenue FROM {prefix}gold.fact_appointment a "
                    f"JOIN {prefix}gold.dim_facility f ON f.facility_hk = a.facility_hk "
                    "WHERE a.visit_type = 'SELF_PAY' GROUP BY f.name")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Warehouse(spark, SF_SMALL).q_revenue_by_facility().collect()))
    days = other.sql(f"SELECT count(DISTINCT snapshot_date) FROM {prefix}business_vault.pit_appointment").first()[0]
    assert 0 < days <= 181
