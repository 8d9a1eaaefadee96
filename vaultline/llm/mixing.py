"""Mixing sources to target weights by Poisson replication.

Every document of source ``s`` is repeated ``Poisson(rate_s)`` times, where
``rate_s = weight_s * total / rows_s`` is the mean repetition that brings the
source to its target share of the output.  The draw inverts the Poisson
distribution at a uniform number hashed from the document id and a seed, so
it is the same in every run and on every executor.

The distribution of a source is a written table of one row per source: its
cumulative probabilities within twelve deviations of the mean (outside of it
nothing is left in double precision), so a rate r takes about 24*sqrt(r) numbers.
As the table's size is known, the planner joins it by broadcast where it is small
and shuffles where it is not.  Rows of sources that repeat a document more than
``BLOCK`` times on average are dealt out as blocks of copies first, so that no task
makes all copies of one row.

The copies are sorted by a hashed key over the whole output.  The key is
uniform, so its leading digits name the partition: one shuffle, no sampling
pass that would run the join twice.

Edge cases: a NULL source is a source of its own; a NULL id hashes as the
empty string; NULL and empty texts are replicated like any other; repeated
rows of one id draw the same count; an empty table gives an empty result;
documents whose draw is 0 leave no row.  Input columns named ``copy``, ``n_copies``,
``rate`` or ``shuffle_key`` are replaced by the result's, all others are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import table, written

SEED = "mix-1"
BLOCK = 1024  # copies of a row that one task makes
ADDED = ("copy", "n_copies", "rate", "shuffle_key")

#: ln k! of small k; from there on Stirling's series is exact to 1e-14.
_SMALL = [math.lgamma(k + 1) for k in range(32)]


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 hash."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|" + seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(2**52))


def log_poisson(k: Column, rate: Column) -> Column:
    """ln P(N = k): directly for small k; else around the mode, where k*ln(rate/k)
    and k - rate cancel without loss."""
    x = k.cast("double")
    small = F.array(*[F.lit(v) for v in _SMALL])
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(
        k < len(_SMALL), -rate + x * F.log(rate) - F.get(small, k.cast("int"))
    ).otherwise(x * F.log1p((rate - x) / x) + (x - rate) - 0.5 * F.log(2 * math.pi * x) - series)


def distributions(rated: DataFrame) -> DataFrame:
    """(mix_source, mix_rate, mix_least, mix_cums) of every source with a positive
    rate: P(N <= mix_least), P(N <= mix_least + 1), ... while below 1."""
    rate = F.col("mix_rate")
    width = 12.0 * F.sqrt(rate) + 24.0
    least = F.when(rate - width < len(_SMALL), F.lit(0)).otherwise(F.floor(rate - width)).cast("bigint")
    steps = rated.filter(rate > 0).select(
        "mix_source", "mix_rate", least.alias("mix_least"),
        F.explode(F.sequence(least, F.ceil(rate + width).cast("bigint"))).alias("k"))
    up_to = Window.partitionBy("mix_source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cums = steps.withColumn("cum", F.sum(F.exp(log_poisson(F.col("k"), rate))).over(up_to))
    kept = F.filter(F.sort_array(F.collect_list(F.struct("k", "cum"))), lambda s: s["cum"] < 1)
    return cums.groupBy("mix_source", "mix_rate", "mix_least").agg(F.transform(kept, lambda s: s["cum"]).alias("mix_cums"))


def rates(docs: DataFrame, weights: dict[str, float] | None, size: float) -> DataFrame:
    """(mix_source, mix_rate): one row per source present in ``docs``.

    ``weights`` maps a source to its relative target weight (sources not
    named get 1); ``None`` gives every source the same share.  ``size`` is the
    output size as a multiple of the input rows.
    """
    counts = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count(F.lit(1)).alias("mix_rows"))
    weight = F.lit(1.0)
    for name, value in sorted((weights or {}).items()):
        weight = F.when(F.col("mix_source") == F.lit(name), F.lit(float(value))).otherwise(weight)
    weighed = counts.withColumn("mix_weight", weight)
    # The totals are one row, so the scalar subquery is a single value.
    total = weighed.agg(F.sum("mix_weight").alias("w"), F.sum("mix_rows").alias("n")).first()
    w, n = float(total["w"] or 1.0), float(total["n"] or 0)
    return weighed.select(
        "mix_source",
        (F.col("mix_weight") / F.lit(w) * F.lit(n * size) / F.col("mix_rows")).alias("mix_rate"),
    )


def replicate(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    size: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, globally shuffled.

    Adds ``copy`` (1..count), ``n_copies``, ``rate`` and ``shuffle_key``.  Rows come
    out sorted by ``shuffle_key`` within and across partitions.
    """
    spark = docs.sparkSession
    drawn_from = written(distributions(rates(docs, weights, size)), "mix-rates")
    kept = [c for c in docs.columns if c not in ADDED]
    packed = docs.select("doc_id", "source", F.struct(*kept).alias("row"))
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def counted(sources: DataFrame) -> DataFrame:
        met = packed.join(sources, F.col("source").eqNullSafe(F.col("mix_source")))
        u = uniform(F.col("doc_id"), seed)
        n = F.col("mix_least") + F.size(F.filter("mix_cums", lambda c: c <= u))
        return met.select("doc_id", "row", F.col("mix_rate").alias("rate"), n.cast("int").alias("n_copies")).filter("n_copies > 0")

    copies = counted(drawn_from.filter(F.col("mix_rate") <= BLOCK)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    many = drawn_from.filter(F.col("mix_rate") > BLOCK)
    if many.limit(1).count():
        blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_copies") - 1) / BLOCK).cast("int")))
        dealt = counted(many).withColumn("block", blocks).repartition(F.xxhash64("doc_id"), "block")
        first = F.col("block") * BLOCK + 1
        copies = copies.unionByName(dealt.withColumn("copy", F.explode(
            F.sequence(first, F.least(first + (BLOCK - 1), F.col("n_copies"))))).drop("block"))
    key = F.md5(F.concat_ws("|", text_id, F.col("copy"), F.lit("order-" + seed)).cast("binary"))
    out = copies.withColumn("shuffle_key", key).select(
        *[F.col("row")[c].alias(c) for c in kept], *ADDED)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The first 32 bits of the key, scaled to the partitions: ranges of equal width.
    place = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("bigint") * parts / 2**32).cast("int")
    return out.repartitionById(parts, place).sortWithinPartitions("shuffle_key")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Every copy of every document, mixed to equal source shares."""
    docs = table(spark, sf_dir, "documents")
    return replicate(docs).select(
        "doc_id", "source", "copy", "n_copies", F.round("rate", 9).alias("rate"), "shuffle_key", "n_chars",
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_md5"),
    )


OP9_SQL = f"""
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), rated AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM counts)::DOUBLE
           * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts
), steps(source, rate, k, log_p, cum) AS (
  SELECT source, rate, 0, -rate, exp(-rate) FROM rated
  UNION ALL
  SELECT source, rate, k + 1, log_p + ln(rate) - ln((k + 1)::DOUBLE),
         cum + exp(log_p + ln(rate) - ln((k + 1)::DOUBLE))
  FROM steps WHERE k < ceil(rate + 12.0 * sqrt(rate) + 24.0)
), drawn AS (
  SELECT doc_id, source, n_chars, md5(coalesce(text, '')) AS text_md5,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{SEED}'), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0 AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.n_chars, d.text_md5, s.rate,
         sum(CASE WHEN s.cum <= d.u THEN 1 ELSE 0 END)::INTEGER AS n_copies
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
  GROUP BY ALL
)
SELECT doc_id, source, copy::INTEGER AS copy, n_copies, round(rate, 9) AS rate,
       md5(coalesce(doc_id::VARCHAR, '') || '|' || copy || '|order-{SEED}') AS shuffle_key,
       n_chars, text_md5
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted WHERE n_copies > 0)
"""
