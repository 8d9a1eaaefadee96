"""Plan properties that matter at scale (not just results)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.constants import AS_OF, LOAD_DATE_1
from vaultline.functions.keys import hash_key
from vaultline.operators.loaders import hub_rows, sat_rows
from vaultline.plans.build import build_warehouse
from vaultline.sources.sinks import stored_table
from vaultline.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(lines, idx):
    """Lines of the ancestors of line ``idx`` in an indented plan tree."""
    def depth(line):
        return len(line) - len(line.lstrip(" :|+-"))
    d, out = depth(lines[idx]), []
    for line in reversed(lines[:idx]):
        if depth(line) < d:
            out.append(line)
            d = depth(line)
    return out


def test_hub_dedup_is_top1_before_the_shuffle(spark):
    o = Tables(spark, SF_SMALL)("orders")
    feed = o.select(hash_key("o_custkey").alias("hk"), F.col("o_custkey").alias("nk"),
                    F.lit("2024-02-01").cast("timestamp_ntz").alias("load_date"),
                    F.lit("orders").alias("record_source"))
    plan = plan_of(hub_rows(feed, "hk", "nk"))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    lines = plan.splitlines()
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    assert any("Exchange" in l for l in ancestors(lines, partial))


def test_bucketed_vault_target_is_not_shuffled(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "wh")
    db = "vault_plan_" + os.path.basename(tmpdir_path).replace("-", "_")
    build_warehouse(spark, SF_SMALL, out, load_date=LOAD_DATE_1, as_of=AS_OF, vault_buckets=4, vault_database=db, run_tests=False)
    stored, = stored_table(spark, out, "raw_vault", "hub_appointment", buckets=("appointment_hk", 4, db)).parts()
    batch = stored.select("appointment_hk", "appointment_id", "load_date", "record_source")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(hub_rows(batch.limit(100), "appointment_hk", "appointment_id",
                                existing=[stored]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scans = [i for i, l in enumerate(lines) if "Bucketed: true" in l and "hub_appointment" in l]
    # The stored side of the anti-join is read bucketed and not shuffled.
    assert any(not any("Exchange" in a for a in ancestors(lines, i)[:3]) for i in scans)
    # The uniqueness test on the bucket key groups the buckets in place.
    from vaultline.operators.checks import Check, table_report

    report = table_report(stored, [Check("h", "appointment_hk", "unique")], {"h": stored}.__getitem__)
    assert "Exchange hashpartitioning" not in plan_of(report)
    assert report.first().failures == 0


def test_hot_user_is_split_by_day(spark):
    """One user holding a third of all events: the bucketed satellite equals
    the plain one, and no (user, day) group comes near the user's total."""
    e = Tables(spark, SF_SMALL)("events")
    hot = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    feed = hot.select(hash_key("user_id").alias("user_hk"), "event_id", "event_type", "ts",
                      F.sha2(F.col("event_type"), 256).alias("hd"), F.lit("events").alias("record_source"))
    args = dict(pk="user_hk", hashdiff="hd", payload=["event_id", "event_type"], ldts="ts",
                tie=lambda: F.col("event_id"))
    plain = sat_rows(feed, **args)
    bucketed = sat_rows(feed, **args, bucket=F.to_date)
    assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0
    sizes = feed.groupBy("user_hk", F.to_date("ts")).count()
    total_hot = hot.filter("user_id = -1").count()
    assert sizes.agg(F.max("count")).first()[0] < total_hot / 10


def test_nothing_is_dealt_out_by_segment(spark):
    """Customers carry their insurer's id without a join or an exchange on the
    few segment values; only the distinct names are gathered."""
    from vaultline.sources.driver_feeds import order_facts

    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        lines = plan_of(order_facts(Tables(spark, SF_SMALL))).splitlines()
    finally:
        for k in off:
            spark.conf.unset(k)
    assert not any("Join" in line and "c_mktsegment" in line for line in lines)
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(c_mktsegment" in line]
    assert all("HashAggregate(keys=[c_mktsegment" in lines[i + 1] for i in dealt)
