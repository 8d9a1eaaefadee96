"""Neighbour-row lookups (previous / next row of a key's ordered history).

The plain form is one window per key.  A key that holds a large share of all
rows would then be sorted in a single task, so both helpers accept a
``bucket`` expression (for example the day of the timestamp) that splits a
key's history into independent window partitions:

1. within ``(key, bucket)`` take ``lag``/``lead`` as usual;
2. per ``(key, bucket)`` aggregate the boundary row (last row for ``lag``,
   first row for ``lead``) with ``max_by``/``min_by`` -- an aggregate with
   map-side partial aggregation, so a hot key is pre-reduced before the
   shuffle;
3. over that small per-bucket summary (one row per key and bucket) take the
   neighbouring bucket's boundary row with a window by key;
4. join the summary back on ``(key, bucket)`` and use it for the first
   (last) row of each bucket.

The result is the same as the single window; only the partitioning differs.
The bucket must be monotone in the ordering (rows of an earlier bucket sort
before rows of a later bucket).

Where one ``(key, bucket)`` may itself be large (a key with all its rows on one
day), ``limit`` splits every group of more rows than that once more, at
positions taken from a hashed sample of its rows (``split_large``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


#: Sampled positions per piece of a split group.
OVERSAMPLE = 16


def split_large(df: DataFrame, keys: Sequence[str], order: str, limit: int, out: str) -> DataFrame:
    """Add ``out``: the piece (0, 1, ...) of its ``keys`` group that a row falls
    into, rising with the ``order`` struct.  Groups of at most ``limit`` rows are
    one piece; larger ones are cut at quantiles of a sample, so pieces hold
    about ``limit`` rows (rows with the same position are never parted).

    The sample takes rows by the hash of their position: the same in every
    run.  Groups above the limit are at most rows/limit, each with
    ``OVERSAMPLE`` positions per piece, so what is joined back is small."""
    def meet(other: DataFrame, how: str) -> DataFrame:
        named = other.select(*[F.col(k).alias(f"_sl_{k}") for k in keys], *[c for c in other.columns if c not in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_sl_{k}")) for k in keys]
        return df.join(named, same, how).drop(*[f"_sl_{k}" for k in keys])

    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sl_n")).filter(F.col("_sl_n") > limit)
    pieces = F.ceil(F.col("_sl_n") / limit)
    step = F.greatest(F.lit(1), F.floor(F.col("_sl_n") / (pieces * OVERSAMPLE)))
    sample = meet(large, "inner").filter(F.pmod(F.xxhash64(order), step) == 0)
    size = F.size("_sl_s")
    cuts = (
        sample.groupBy(*keys).agg(F.sort_array(F.collect_set(order)).alias("_sl_s"), F.first(pieces).alias("_sl_p"))
        .select(*keys, F.transform(
            F.sequence(F.lit(1), F.greatest(F.col("_sl_p") - 1, F.lit(1)).cast("int")),
            lambda i: F.element_at("_sl_s", F.least(size, F.floor(i * size / F.col("_sl_p")).cast("int") + 1)),
        ).alias("_sl_cuts"))
    )
    piece = F.size(F.filter("_sl_cuts", lambda c: c <= F.col(order)))
    return meet(cuts, "left").withColumn(
        out, F.when(F.col("_sl_cuts").isNull(), 0).otherwise(piece)).drop("_sl_cuts")


def _neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str,
    bucket: Column | None,
    previous: bool,
    limit: int | None = None,
) -> DataFrame:
    fn = F.lag if previous else F.lead
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(out, fn(F.col(value)).over(w))

    b = "_nb_bucket"
    o = "_nb_order"
    with_b = df.withColumn(b, bucket).withColumn(o, F.struct(*_cols(order)))
    if limit is not None:
        with_b = split_large(with_b, [*keys, b], o, limit, "_nb_piece").withColumn(
            b, F.struct(F.col(b).alias("b"), F.col("_nb_piece").alias("p"))).drop("_nb_piece")
    pick = F.max_by if previous else F.min_by
    boundary = with_b.groupBy(*keys, b).agg(
        pick(F.col(value), F.col(o)).alias("_nb_edge")
    )
    wb = Window.partitionBy(*keys).orderBy(F.col(b))
    summary = boundary.select(
        *[F.col(k).alias("_nb_k_" + k) for k in keys],
        F.col(b).alias("_nb_kb"),
        fn(F.col("_nb_edge")).over(wb).alias("_nb_carry"),
    )
    cond = [F.col(k).eqNullSafe(F.col("_nb_k_" + k)) for k in keys]
    cond.append(F.col(b).eqNullSafe(F.col("_nb_kb")))
    w = Window.partitionBy(*keys, b).orderBy(F.col(o))
    # A NULL struct means "no neighbour inside the bucket"; a struct holding a
    # NULL field is a real neighbour whose value is NULL.
    near = fn(F.struct(F.col(value).alias("v"))).over(w)
    return (
        with_b.join(summary, cond, "inner")
        .withColumn(out, F.when(near.isNull(), F.col("_nb_carry")).otherwise(near["v"]))
        .drop(b, o, "_nb_carry", "_nb_kb", *["_nb_k_" + k for k in keys])
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str,
    bucket: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key."""
    return _neighbour(df, keys, order, value, out, bucket, previous=True, limit=limit)


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str,
    bucket: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same key."""
    return _neighbour(df, keys, order, value, out, bucket, previous=False, limit=limit)
