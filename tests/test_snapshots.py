"""Incremental point-in-time table; satellite loads against long histories."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vaultline.operators.asof import pit
from vaultline.operators.loaders import sat_rows
from vaultline.operators.sequence import next_value, previous_value, split_large
from vaultline.plans.snapshots import refresh_pit
from vaultline.sources.stored import StoredTable

T, D = dt.datetime, dt.date
ROW = "k string, ts timestamp_ntz, v string"


def refreshed(spark, table, keys, rows, start, end, before):
    frames = spark.createDataFrame([(k,) for k in keys], "k string"), spark.createDataFrame(rows, ROW)
    days = refresh_pit(table, *frames, key="k", ts="ts", value="v", start=start, end=end, before=before, tie=["v"],
                       value_name="v", ts_name="ts")
    want = pit(*frames, key="k", ts="ts", values=["v"], start=start, end=end, tie=["v"])
    got = table.read()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    return days, frames


def files_by_day(table):
    return {p.rsplit("=", 1)[1]: p for p in table.commit()["parts"]}


def test_only_changed_days_are_rewritten(spark, tmpdir_path):
    t = StoredTable(spark, tmpdir_path + "/pit")
    start, end = D(2024, 1, 1), D(2024, 1, 10)
    rows = [("a", T(2024, 1, 2), "x"), ("a", T(2024, 1, 8, 9), "y"), ("b", T(2024, 1, 3), "x"), ("zz", T(2024, 1, 1), "q")]
    days, before = refreshed(spark, t, ["a", "b"], rows, start, end, None)
    assert days is None
    old = files_by_day(t)
    # Nothing new: nothing written.
    assert refreshed(spark, t, ["a", "b"], rows, start, end, before)[0] == []
    assert t.versions() == [1]
    # A late event of a shows until its next event takes over on the 9th.
    late = [*rows, ("a", T(2024, 1, 4, 12), "w")]
    days, before = refreshed(spark, t, ["a", "b"], late, start, end, before)
    assert days == [D(2024, 1, i) for i in range(5, 9)]
    new = files_by_day(t)
    assert {d for d in old if old[d] != new[d]} == {str(d) for d in days} and set(old) == set(new)
    # A correction (one row gone, one changed), a new key and a window two days on.
    fixed = [r for r in late if r[2] != "w"] + [("c", T(2024, 1, 11, 1), "x")]
    fixed[fixed.index(("b", T(2024, 1, 3), "x"))] = ("b", T(2024, 1, 3), "y")
    days, before = refreshed(spark, t, ["a", "b", "c", "zz"], fixed, D(2024, 1, 3), D(2024, 1, 12), before)
    assert days == [D(2024, 1, i) for i in range(3, 13)]
    assert set(files_by_day(t)) == {str(D(2024, 1, i)) for i in range(3, 13)}
    # The window moves back again: days to come go, none is rewritten but the new ones.
    days, before = refreshed(spark, t, ["a", "b", "c", "zz"], fixed, D(2024, 1, 2), D(2024, 1, 11), before)
    assert days == [D(2024, 1, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_refreshes_equal_full_rebuilds(spark, tmpdir_path, seed):
    rnd = random.Random(seed)
    t = StoredTable(spark, tmpdir_path + "/pit")
    rows, before, end = [], None, D(2024, 1, 20)
    for _ in range(4):
        rows = [r for r in rows if rnd.random() > 0.05]
        rows += [(f"k{rnd.randrange(6)}", T(2024, 1, 1) + dt.timedelta(hours=12 * rnd.randrange(50)), rnd.choice("xyz"))
                 for _ in range(12)]
        end += dt.timedelta(days=rnd.randrange(-1, 3))
        _, before = refreshed(spark, t, [f"k{i}" for i in range(5)], rows, end - dt.timedelta(days=15), end, before)


# --- satellites ---

SAT = "hk string, hd string, v string, ts timestamp_ntz, record_source string"
ARGS = dict(pk="hk", hashdiff="hd", payload=["v"], ldts="ts", tie=lambda: F.col("v"))


def day_of_one_key(spark, n, at=0):
    """``n`` rows, most of one key on one day, several on the same instant."""
    rows = []
    for i in range(at, at + n):
        ts = T(2024, 1, 1) + dt.timedelta(minutes=(i // 3) % 1400)
        rows.append(("hot" if i % 5 else f"k{i % 7}", "AB"[(i * 7) % 5 % 2], f"{i:06d}", ts, "s1" if i % 2 else None))
    return spark.createDataFrame(rows, SAT)


def chains(df):
    return sorted(map(str, df.select("hk", "hd", "v", "ts", "record_source").collect()))


def test_a_day_of_one_key_is_split_and_equals_the_plain_load(spark):
    stored, batch = sat_rows(day_of_one_key(spark, 500), **ARGS), day_of_one_key(spark, 900, at=200)
    plain = sat_rows(batch, existing=stored, **ARGS)
    split = sat_rows(batch, existing=stored, bucket=F.to_date, limit=40, **ARGS)
    assert chains(split) == chains(plain) != []
    # Stored in parts, as bucketed targets are.
    half = F.col("v") < "000100"
    parts = [stored.filter(half), stored.filter(~half)]
    assert chains(sat_rows(batch, existing=parts, bucket=F.to_date, limit=40, **ARGS)) == chains(plain)
    assert sat_rows(batch, existing=[stored, plain], bucket=F.to_date, limit=40, **ARGS).count() == 0


def test_pieces_of_a_large_group(spark):
    df = day_of_one_key(spark, 1000).withColumn("d", F.to_date("ts")).withColumn("o", F.struct("ts", "v"))
    got = split_large(df, ["hk", "record_source", "d"], "o", 50, "piece")
    assert got.count() == 1000
    sizes = {(r.hk, r.record_source, r.piece): r["count"] for r in got.groupBy("hk", "record_source", "piece").count().collect()}
    hot = [n for (k, _, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 12 and max(hot) <= 150 and {p for k, _, p in sizes if k != "hot"} == {0}
    # Pieces follow the order.
    spans = got.filter("hk = 'hot' AND record_source = 's1'").groupBy("piece").agg(F.min("o").alias("a"), F.max("o").alias("b")).orderBy("piece").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
    for fn in (previous_value, next_value):
        plain = fn(df, ["hk", "record_source"], ["ts", "v"], "v", "n")
        cut = fn(df, ["hk", "record_source"], ["ts", "v"], "v", "n", bucket=F.col("d"), limit=50)
        assert sorted(map(str, cut.select("v", "n").collect())) == sorted(map(str, plain.select("v", "n").collect()))


def test_a_stored_history_is_never_sorted_by_key(spark):
    """Anchors are partial aggregates: below them no sort but a join's, and the only
    windows are those of the (key, day, piece) groups."""
    from test_plans import plan_of

    stored, batch = day_of_one_key(spark, 300), day_of_one_key(spark, 300, at=100)
    plan = plan_of(sat_rows(batch, existing=stored, bucket=F.to_date, limit=40, **ARGS))
    windows = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert windows and all("_nb_bucket" in line for line in windows)
    assert "functions=[partial_max(ts" in plan
