"""Point-in-time resolution against a brute-force spine x history join."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultline.operators.asof import asof_day, pit

T = dt.datetime


def history(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, status string, rank int")


def parents(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def brute(spark, par, hist, start, days):
    spine = par.crossJoin(
        spark.createDataFrame([(start + dt.timedelta(days=i),) for i in range(days)], "d date"))
    j = spine.join(hist, (spine.k == hist.k) & (hist.ts <= F.col("d").cast("timestamp_ntz")))
    w = Window.partitionBy(spine.k, "d").orderBy(hist.ts.desc(), F.col("rank").desc())
    return sorted(
        (r[0], r[1], r[2]) for r in j.select(spine.k, "d", "status", F.row_number().over(w).alias("rn"))
        .filter("rn = 1").drop("rn").collect())


def run(spark, rows, keys, start, end, bucket=None):
    p = pit(parents(spark, keys), history(spark, rows), "k", "ts", ["status"],
            start=start, end=end, tie=["rank"], bucket=bucket)
    return sorted((r.k, r.snapshot_date, r.status) for r in p.collect())


def test_midnight_same_day_daytime_next_day(spark):
    rows = [("a", T(2024, 1, 2), "S", 1), ("b", T(2024, 1, 2, 9), "S", 1)]
    got = run(spark, rows, ["a", "b"], dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert got == [("a", dt.date(2024, 1, 2), "S"), ("a", dt.date(2024, 1, 3), "S"),
                   ("b", dt.date(2024, 1, 3), "S")]


def test_tie_resolved_by_rank_and_unknown_keys_ignored(spark):
    rows = [("a", T(2024, 1, 1), "CONFIRMED", 2), ("a", T(2024, 1, 1), "SCHEDULED", 1),
            ("zz", T(2024, 1, 1), "X", 1)]
    got = run(spark, rows, ["a"], dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert got == [("a", dt.date(2024, 1, 1), "CONFIRMED"), ("a", dt.date(2024, 1, 2), "CONFIRMED")]


def test_random_histories_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        k = "k%d" % rnd.randrange(6)
        day = rnd.randrange(12)
        hour = rnd.choice([0, 0, 5, 13])
        rows.append((k, T(2024, 1, 1) + dt.timedelta(days=day, hours=hour),
                     rnd.choice("ABC"), i))
    keys = ["k%d" % i for i in range(7)]
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 14)
    expect = brute(spark, parents(spark, keys), history(spark, rows), start, 12)
    assert run(spark, rows, keys, start, end) == expect
    assert run(spark, rows, keys, start, end, bucket=F.to_date("ts")) == expect


def test_asof_day_equals_pit_row(spark):
    rows = [("a", T(2024, 1, 1), "S", 1), ("a", T(2024, 1, 5, 10), "C", 2),
            ("b", T(2024, 1, 6), "S", 1)]
    h, p = history(spark, rows), parents(spark, ["a", "b"])
    one = asof_day(p, h, "k", "ts", ["status"], dt.date(2024, 1, 6), tie=["rank"])
    got = sorted((r.k, r.status) for r in one.collect())
    assert got == [("a", "C"), ("b", "S")]


def test_daily_counts_equal_grouped_pit(spark):
    from vaultline.operators.asof import daily_counts

    rnd = random.Random(5)
    rows = [("k%d" % rnd.randrange(9), T(2024, 1, 1) + dt.timedelta(days=rnd.randrange(15),
             hours=rnd.choice([0, 7])), rnd.choice("ABC"), i) for i in range(200)]
    h, p = history(spark, rows), parents(spark, ["k%d" % i for i in range(8)])
    start, end = dt.date(2024, 1, 4), dt.date(2024, 1, 20)
    full = pit(p, h, "k", "ts", ["status"], start=start, end=end, tie=["rank"])
    expect = sorted(tuple(r) for r in full.groupBy("snapshot_date", "status").count().collect())
    got = sorted(tuple(r) for r in daily_counts(p, h, "k", "ts", "status", start, end,
                                                tie=["rank"]).collect())
    assert got == expect
