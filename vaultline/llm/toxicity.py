"""Toxicity severity by cumulative-link ordinal regression.

``P(grade > j | x) = sigmoid(w.x - c_j)`` with one weight vector ``w`` shared
by all thresholds ``c_0 < c_1 < ...``; the score is the expected severity
``sum_j P(grade > j)`` between 0 and the highest grade.

Features are sparse: ``1 + log(count)`` of each selected word held.  Words are
selected on the labelled sample by how much more often toxic documents hold
them than chance allows, so a long clean text adds nothing and a long toxic
text is not diluted.  The labels are binary, so the training grades of toxic
documents are the number of selected-word occurrences in them, cut at
``GRADE_CUTS``: 1 = a few, 2 = several, 3 = many; clean documents are grade 0.

Training uses a sample of at most ``SAMPLE`` labelled documents, the smallest
by hashed id.  Their words are counted per class in Spark; the driver gets the
selected words (at most ``MAX_FEATURES``) and how often each sampled document
holds those.  Scoring covers every document, map-side, without a shuffle.

Edge cases: NULL and empty texts have no words and get the model's lowest
severity; labels without a document, with NULL values, or repeated rows of an
id are ignored or merged (an id is toxic if any of its labels is); with no toxic or no
clean labelled document nothing can be learned and every severity is 0; extra
columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import ALNUM, pieces, small_batches, table, tokenize, written

SAMPLE = 6000  # labelled documents to fit on (documented bound)
FALSE_WORDS = 5  # words expected to reach the bound by chance
MIN_DOCS = 3  # toxic documents that must hold a feature word, at least
MIN_SHARE = 0.02  # and as a share of the toxic documents
MIN_PRECISION = 0.5  # share of the documents holding it that are toxic
MAX_FEATURES = 4096  # a model size, the strongest associations first
GRADE_CUTS = (3, 8)  # occurrences from which grade 2, grade 3
REJECT = 0.15  # expected severity from which a document is toxic
PENALTY = 1e-2
STEPS = 3000  # gradient steps; the sample has few non-zero features


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted uint64 word hashes
    weights: np.ndarray
    cuts: np.ndarray  # ascending thresholds, one per grade above 0


def _bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct word hashes and counts per text."""
    t = tokenize(texts, ALNUM)
    return [np.unique(t.hash[a:b], return_counts=True) for a, b in zip(t.first[:-1], t.first[1:], strict=True)]


def _bag_rows(batches):
    for b in batches:
        bags = _bags(b.column(b.schema.get_field_index("text")))
        yield pa.RecordBatch.from_arrays(
            [b.column(b.schema.get_field_index("toxic")),
             pa.array([h.astype(np.int64) for h, _ in bags], pa.list_(pa.int64())),
             pa.array([c.astype(np.int64) for _, c in bags], pa.list_(pa.int64()))],
            names=["toxic", "words", "counts"])


def sampled_bags(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, words, counts) of the documents of at most ``sample`` labels."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    # At most ``sample`` rows, so this side is broadcast.
    joined = texts.join(F.broadcast(picked), F.col("_id") == F.col("doc_id")).select(
        F.col("toxic").cast("int").alias("toxic"), "text")
    return written(joined.mapInArrow(_bag_rows, "toxic int, words array<long>, counts array<long>"), "toxicity-bags")


def selected_words(bags: DataFrame) -> np.ndarray:
    """Hashes of the words that toxic documents hold clearly more often."""
    n = bags.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("toxic") > 0).alias("toxic")).first()
    if not n.toxic or n.toxic == n["all"]:
        return np.zeros(0, np.uint64)
    held = written(bags.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") > 0).alias("in_toxic")), "toxicity-words")
    # Chernoff bound on seeing the word in that many toxic documents by
    # chance, with at most FALSE_WORDS words expected to pass by chance.
    share = n.toxic / n["all"]
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("in_toxic") / F.col("n")))
    bound = F.col("n") * (p * F.log(p / share) + (1 - p) * F.log((1 - p) / (1 - share)))
    good = held.withColumn("bound", bound).filter(
        (F.col("in_toxic") >= max(MIN_DOCS, MIN_SHARE * n.toxic)) & (p > max(share, MIN_PRECISION))
        & (F.col("bound") >= float(np.log(held.count() / FALSE_WORDS))))
    words = good.orderBy(F.col("bound").desc(), "word").limit(MAX_FEATURES).select("word").toArrow()
    return np.sort(words.column("word").to_numpy().astype(np.int64).view(np.uint64))


def _feature_rows(words: np.ndarray):
    """Bags cut down to the selected words: their places and counts."""
    def run(batches):
        for b in batches:
            lists = b.column("words")
            doc = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            hashes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            counts = b.column("counts").flatten().to_numpy(zero_copy_only=False)
            d, f, c = _counts(words, hashes, counts, doc)
            ends = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=b.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), *[pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int64))) for v in (f, c)]],
                names=["toxic", "features", "counts"])

    return run


def _counts(words: np.ndarray, hashes: np.ndarray, counts: np.ndarray, doc: np.ndarray) -> tuple:
    """(doc, feature, count) of the selected words among the given ones."""
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[at] == hashes
    return doc[hit], at[hit], counts[hit]


def fit(words: np.ndarray, toxic: np.ndarray, d: np.ndarray, f: np.ndarray, c: np.ndarray) -> Model:
    """Fits by gradient descent with adaptive steps on the small sample: document
    ``d[i]`` holds word ``f[i]`` ``c[i]`` times."""
    if not len(words) or toxic.all() or not toxic.any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf]))
    n = len(toxic)
    held = np.bincount(d, c, n)
    grade = np.where(toxic, 1 + sum((held >= cut).astype(int) for cut in GRADE_CUTS), 0)
    top = int(grade.max())
    above = (grade[:, None] > np.arange(top)).astype(float)
    x = 1 + np.log(c)
    # Thresholds stay ordered: c_0 free, then positive gaps exp(g).
    w, base, gaps = np.zeros(len(words)), 1.0, np.zeros(top - 1)
    params = np.concatenate([w, [base], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, cuts = params[: len(words)], params[len(words)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(words) + 1 :]))])
        eta = np.bincount(d, w[f] * x, n)
        err = 1 / (1 + np.exp(-np.clip(eta[:, None] - cuts, -40, 40))) - above
        per_doc, per_cut = err.sum(1) / n, -err.sum(0) / n
        grad_w = np.bincount(f, per_doc[d] * x, len(words)) + PENALTY * w / len(words)
        grad_g = np.exp(params[len(words) + 1 :]) * np.cumsum(per_cut[::-1])[::-1][1:]
        grad = np.concatenate([grad_w, [per_cut.sum()], grad_g])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cuts = params[len(words)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(words) + 1 :]))])
    return Model(words, params[: len(words)], cuts)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    small_batches(docs.sparkSession)
    bags = sampled_bags(docs, labels, sample)
    words = selected_words(bags)
    if not len(words):
        return fit(words, np.zeros(0, bool), *[np.zeros(0, np.int64)] * 3)
    # At most ``sample`` documents with their selected words.
    rows = bags.mapInArrow(_feature_rows(words), "toxic int, features array<long>, counts array<long>").toArrow()
    lists = rows.column("features").combine_chunks()
    return fit(words, rows.column("toxic").to_numpy() > 0,
               np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy(zero_copy_only=False)),
               lists.flatten().to_numpy(zero_copy_only=False),
               rows.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False))


def severity(model: Model, text: str = "text") -> Column:
    """Expected severity of each text."""

    def part(texts: pa.Array) -> np.ndarray:
        t = tokenize(texts, ALNUM)
        d, f, _ = _counts(model.words, t.hash, np.ones(len(t), np.int64), t.doc)
        pair, times = np.unique(d * len(model.words) + f, return_counts=True)
        weight = model.weights[pair % len(model.words)] * (1 + np.log(times))
        eta = np.bincount(pair // len(model.words), weight, len(texts))
        return (1 / (1 + np.exp(-np.clip(eta[:, None] - model.cuts, -40, 40)))).sum(1)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not len(model.words):
            return pa.array(np.zeros(len(texts)))
        return pa.array(np.concatenate([part(texts[a:b]) for a, b in pieces(texts)] or [np.zeros(0)]))

    return score(F.col(text))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the column ``severity`` (replaced if there)."""
    model = train(docs, labels)
    return docs.withColumn("severity", severity(model))


def keep_clean(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without those of expected severity ``reject`` or more."""
    model = train(docs, labels)
    # The input may have a column of any name, so the score gets an unused one.
    name = "_severity"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, severity(model)).filter(F.col(name) < reject).drop(name)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = rated(docs, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", F.round("severity", 6).alias("severity"), F.round("severity").cast("int").alias("grade"),
        (F.col("severity") >= REJECT).cast("int").alias("toxic"),
    )
