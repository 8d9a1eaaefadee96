"""Hash keys are derived late: neither written by staging nor shuffled as text."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.functions.keys import pack_key, unpack_key
from vaultline.operators.checks import Check, table_report
from vaultline.operators.loaders import link_rows
from vaultline.plans.scenarios import LINE_IDS, link_incremental, link_load, link_written
from vaultline.plans.warehouse import Warehouse
from vaultline.session import scratch_path
from vaultline.sources.stored import StoredTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_keys_are_one_to_one(spark):
    h = "ab" * 32
    texts = [h, h.upper(), h[:-1], "g" * 64, "", None, " x", "\x00" * 32, "é", "0" * 64]
    df = spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", pack_key("k"))
    rows = df.select("k", "p", unpack_key("p").alias("u")).collect()
    assert [r.u for r in rows] == texts
    assert len({r.p and bytes(r.p) for r in rows}) == len(texts)
    assert len(rows[0].p) == 32


def test_written_staging_holds_no_key_that_follows_from_its_ids(spark):
    wh = Warehouse(spark, SF_SMALL)
    wh.prepare("fact_appointment")
    written = spark.read.parquet(scratch_path(spark, "tables", wh.run_id, "stg_appointments"))
    assert {"appointment_hk", "lnk_appointment_hk", "hd_appointment_detail", "specialty_hk"} & set(written.columns) == set()
    lazy = Warehouse(spark, SF_SMALL, materialize=False)
    for name in ("stg_appointments", "stg_exams", "bridge_encounter", "fact_appointment"):
        a, b = wh.model(name), lazy.model(name)
        assert a.dtypes == b.dtypes and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    wh.cleanup()
    assert wh.model("stg_appointments").count() == lazy.model("stg_appointments").count()


@pytest.mark.parametrize("query", [link_load, link_incremental])
def test_link_keys_are_not_shuffled(spark, tmpdir_path, query):
    rows = [(1, 1, 1, "1997-01-01"), (1, 1, 1, "1999-01-01"), (1, 2, 1, "1999-01-01"), (None, 1, 1, "1997-01-01"), (2, 1, 1, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, d string").withColumn(
        "l_shipdate", F.col("d").cast("timestamp_ntz")).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    out = query(spark, tmpdir_path)
    plan = plan_of(out).splitlines()
    assert not any("Exchange" in line and "_hk" in line for line in plan)
    got = sorted((r.lnk_order_line_hk, str(r.load_date)[:10]) for r in out.collect())
    assert len(got) == len({k for k, _ in got}) == 3
    days = sorted(d for _, d in got)
    assert days == (["2024-02-01"] * 3 if query is link_load else ["2024-02-01", "2024-02-02", "2024-02-02"])


def test_the_written_link_is_stored_and_compared_by_ids(spark, tmpdir_path, monkeypatch):
    rows = [(1, 1, 1, "1997-01-01"), (1, 1, 1, "1997-01-01"), (1, 1, 1, "1999-01-01"), (1, 2, 1, "1999-01-01"),
            (1, 2, 1, "1999-02-01"), (None, 1, 1, "1997-01-01"), (1, None, 1, "1999-01-01"), (2, 1, 1, None), (12, 1, 1, "1996-01-01")]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, d string").withColumn(
        "l_shipdate", F.col("d").cast("timestamp_ntz")).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    plans, append = [], StoredTable.append

    def watched(self, df, batch=None, meta=None):
        plans.append((batch, plan_of(df)))
        return append(self, df, batch, meta)

    monkeypatch.setattr(StoredTable, "append", watched)
    out = link_written(spark, tmpdir_path)
    assert [b for b, _ in plans] == ["batch-0", "batch-1", "batch-1"]  # the last one is retried
    assert not any("_hk" in line or "sha2" in line for _, p in plans for line in p.splitlines())
    # The second batch is dealt out once for its distinct ids and their comparison, and the stored ids once.
    assert plans[1][1].count("Exchange hashpartitioning") == 3  # with the layout of the new rows
    assert "BroadcastExchange" not in plans[1][1]
    assert spark.read.parquet(*out.inputFiles()).columns == [*LINE_IDS, "load_date", "record_source"]
    whole = link_incremental(spark, tmpdir_path)
    assert out.dtypes == whole.dtypes and out.exceptAll(whole).count() == 0 == whole.exceptAll(out).count()
    assert sorted(str(r.load_date)[:10] for r in out.collect()) == ["2024-02-01"] * 2 + ["2024-02-02"] * 2


def test_narrow_link_rows_need_their_ids(spark):
    df = spark.createDataFrame([("p", "a")], "pk string, a string")
    with pytest.raises(ValueError):
        link_rows(df, "pk", ["a"], keys_checked=True, distinct_keys=True, then=lambda rows: rows)


def test_links_dealt_out_by_a_hub_key_keep_one_row(spark):
    df = spark.createDataFrame([("p", "a", "x"), ("p", "a", "x"), ("q", "a", "y"), ("r", None, "z"), (None, "b", "z")],
                               "pk string, a string, b string").withColumn("load_date", F.lit(1)).withColumn("record_source", F.lit("s"))
    out = link_rows(df, "pk", ["a", "b"], by="a")
    got = out.select(unpack_key("a").alias("a"), unpack_key("b").alias("b"))
    assert sorted(map(tuple, got.collect())) == [("a", "x"), ("a", "y")]
    assert plan_of(out).count("Exchange") == 1


def test_unique_tests_of_several_columns_on_packed_values(spark):
    df = spark.createDataFrame([("a", "ab" * 32), ("a", "ab" * 32), ("b", None), (None, "cd" * 32)], "x string, y string")
    checks = [Check("m", c, t) for c in ("x", "y") for t in ("unique", "not_null")]
    assert [r.failures for r in table_report(df, checks, {"m": df}.__getitem__).collect()] == [1, 1, 1, 1]
