"""As-of resolution: which history row is in effect on a given day.

Semantics (the point-in-time table): for every parent key and every
snapshot day ``d`` in ``[start, end]``, the latest history row with
``ts <= d`` where ``d`` is compared as midnight -- so an event at 09:00 on
day D shows from D+1, an event at 00:00 shows on D.  No row before a key's
first event.  Ties on ``ts`` are broken by ``tie`` (then nothing else: the
caller's tie columns must make the order total).

The literal form (parent x days, join ``ts <= d``, keep the latest) costs
events x days.  Here each history row is turned into the interval of days it
is in effect, by looking at the *next* row of the same key, and the interval
is exploded: one shuffle by key and output-sized work.

    first_day = date(ts)       if ts is midnight else date(ts) + 1
    last_day  = end            if there is no next row
              = date(next) - 1 if next is midnight
              = date(next)     otherwise
    clip to [start, end], keep first_day <= last_day, explode the days

With tied timestamps the earlier row of the tie gets first_day > last_day and
disappears, which is what "latest by (ts, tie)" means.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.dates import is_midnight, midnight
from vaultline.operators.sequence import next_value


def _lit_date(d: str | _dt.date) -> Column:
    return F.lit(str(d)).cast("date")


def in_effect_intervals(
    history: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str | Column] = (),
    end: str | _dt.date | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``_first_day``/``_last_day``: the days on which each row is in effect."""
    order = [F.col(ts), *[F.col(t) if isinstance(t, str) else t for t in tie]]
    h = next_value(history, [key], order, ts, "_next_ts", bucket=bucket)
    t = F.col(ts)
    nxt = F.col("_next_ts")
    first_day = F.when(is_midnight(t), F.to_date(t)).otherwise(F.date_add(F.to_date(t), 1))
    open_end = _lit_date(end) if end is not None else F.lit(None).cast("date")
    last_day = (
        F.when(nxt.isNull(), open_end)
        .when(is_midnight(nxt), F.date_sub(F.to_date(nxt), 1))
        .otherwise(F.to_date(nxt))
    )
    return h.withColumn("_first_day", first_day).withColumn("_last_day", last_day).drop("_next_ts")


def pit(
    parents: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    values: Sequence[str],
    start: str | _dt.date,
    end: str | _dt.date,
    tie: Sequence[str | Column] = (),
    value_names: Sequence[str] | None = None,
    ts_name: str | None = None,
    bucket: Column | None = None,
    days: Sequence[_dt.date] | None = None,
    key_as: Column | None = None,
) -> DataFrame:
    """Point-in-time table ``(key, snapshot_date, values..., ts)``.

    ``parents`` restricts the keys (semi join, like the spine's hub); history
    rows of unknown keys are ignored.  ``days`` gives only these days of
    ``[start, end]``.  ``key_as`` is what is returned for the key, derived once per
    history row (not per day).
    """
    keep = [key, ts, *values, *[t for t in tie if isinstance(t, str)]]
    h = history.select(*dict.fromkeys(keep))
    h = h.join(parents.select(key), key, "left_semi")
    iv = in_effect_intervals(h, key, ts, tie=tie, end=end, bucket=bucket)
    lo = F.greatest(F.col("_first_day"), _lit_date(start))
    hi = F.least(F.col("_last_day"), _lit_date(end))
    names = list(value_names or values)
    span = F.sequence(F.col("_lo"), F.col("_hi"))
    if days is not None:
        # Rows in effect on none of the days give nothing, before any explode.
        wanted = F.array(*[_lit_date(d) for d in sorted(days)]).cast("array<date>")
        span = F.filter(wanted, lambda d: (d >= F.col("_lo")) & (d <= F.col("_hi")))
    return (
        iv.withColumn("_lo", lo)
        .withColumn("_hi", hi)
        .filter(F.col("_lo") <= F.col("_hi"))
        .withColumn("_key", F.col(key) if key_as is None else key_as)
        .select(
            F.col("_key").alias(key),
            F.explode(span).alias("snapshot_date"),
            *[F.col(v).alias(n) for v, n in zip(values, names)],
            F.col(ts).alias(ts_name or ts),
        )
    )


def _day_sets(history: DataFrame, changed: DataFrame, key: str, ts: str, value: str, tie, start, end, bucket) -> DataFrame:
    """Days of ``[start, end]`` on which the ``changed`` rows of ``history`` are in effect."""
    touched = history.join(changed.select(key).distinct(), key, "left_semi")
    iv = in_effect_intervals(touched, key, ts, tie=tie, end=end, bucket=bucket)
    same = [iv[c].eqNullSafe(changed[c]) for c in (key, ts, value)]
    days = F.sequence(F.greatest(F.col("_first_day"), _lit_date(start)), F.least(F.col("_last_day"), _lit_date(end)))
    return (
        iv.join(changed, same, "left_semi")
        .filter((F.greatest(F.col("_first_day"), _lit_date(start)) <= F.least(F.col("_last_day"), _lit_date(end))))
        .select(F.explode(days).alias("snapshot_date")).distinct()
    )


def changed_days(
    before: tuple[DataFrame, DataFrame],
    after: tuple[DataFrame, DataFrame],
    key: str,
    ts: str,
    value: str,
    start: str | _dt.date,
    end: str | _dt.date,
    tie: Sequence[str | Column] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """The days of ``[start, end]`` whose snapshot differs between two states
    ``(parents, history)``: ``(snapshot_date)``, at most one row per day.

    A snapshot row changes on a day only if the row in effect then was added
    since, or the one that was in effect before was removed: a row present in
    both states that is the latest in the new one was the latest in the old
    one, or gave way to a removed row.  So the two histories are compared (one
    shuffle, partial aggregation), and only the keys that differ are looked at.
    """
    states = [h.join(p.select(key), key, "left_semi") for p, h in (before, after)]
    marked = [h.select(key, ts, value, F.lit(i == 0).alias("_old"), F.lit(i == 1).alias("_new")) for i, h in enumerate(states)]
    differ = marked[0].unionByName(marked[1]).groupBy(key, ts, value).agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new")).filter(F.col("_old") != F.col("_new"))
    sides = [
        _day_sets(h, differ.filter(F.col(flag)).select(key, ts, value), key, ts, value, tie, start, end, bucket)
        for h, flag in zip(states, ("_old", "_new"))
    ]
    return sides[0].unionByName(sides[1]).distinct()


def asof_day(
    parents: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    values: Sequence[str],
    day: str | _dt.date,
    tie: Sequence[str | Column] = (),
    value_names: Sequence[str] | None = None,
    ts_name: str | None = None,
) -> DataFrame:
    """The row in effect on one day, per key: ``(key, values..., ts)``.

    One aggregate (``max_by``, partial map-side) instead of the
    whole point-in-time table: a hot key is reduced map-side.
    """
    order = F.struct(F.col(ts), *[F.col(t) if isinstance(t, str) else t for t in tie])
    names = list(value_names or values)
    picked = (
        history.filter(F.col(ts) <= midnight(day))
        .join(parents.select(key), key, "left_semi")
        .groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(v) for v in values], F.col(ts)), order).alias("_p"))
    )
    return picked.select(
        key,
        *[F.col("_p")[v].alias(n) for v, n in zip(values, names)],
        F.col("_p")[ts].alias(ts_name or ts),
    )


def daily_counts(
    parents: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    value: str,
    start: str | _dt.date,
    end: str | _dt.date,
    tie: Sequence[str | Column] = (),
    value_name: str | None = None,
    count_name: str = "n",
) -> DataFrame:
    """Per day in ``[start, end]`` and value: how many keys have that value in
    effect -- the point-in-time table grouped by (day, value), computed
    without building it.

    Sweep line: every in-effect interval adds +1 on its first day and -1 on
    the day after its last; a running sum per value over those change days
    gives the count, constant until the next change day, and only those runs
    are exploded to days.  Work is O(history rows + days), not O(keys x days).
    """
    keep = [key, ts, value, *[t for t in tie if isinstance(t, str)]]
    h = history.select(*dict.fromkeys(keep)).join(parents.select(key), key, "left_semi")
    iv = in_effect_intervals(h, key, ts, tie=tie, end=end)
    lo = F.greatest(F.col("_first_day"), _lit_date(start))
    hi = F.least(F.col("_last_day"), _lit_date(end))
    spans = iv.select(F.col(value).alias("_v"), lo.alias("_lo"), hi.alias("_hi")).filter(
        F.col("_lo") <= F.col("_hi"))
    changes = spans.select(
        "_v",
        F.explode(F.array(
            F.struct(F.col("_lo").alias("d"), F.lit(1).alias("delta")),
            F.struct(F.date_add(F.col("_hi"), 1).alias("d"), F.lit(-1).alias("delta")),
        )).alias("c"),
    ).groupBy("_v", F.col("c.d").alias("_d")).agg(F.sum("c.delta").alias("_delta"))
    w = Window.partitionBy("_v").orderBy("_d")
    runs = changes.select(
        "_v", "_d",
        F.sum("_delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_n"),
        F.lead("_d").over(w).alias("_next"),
    ).filter((F.col("_n") > 0) & F.col("_next").isNotNull())
    return runs.select(
        F.explode(F.sequence(F.col("_d"), F.date_sub(F.col("_next"), 1))).alias("snapshot_date"),
        F.col("_v").alias(value_name or value),
        F.col("_n").cast("bigint").alias(count_name),
    )
