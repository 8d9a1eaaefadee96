"""Quality classifier: regularised quadratic discriminant analysis.

Every text is reduced to ``len(STATISTICS)`` document statistics, each
transformed to be roughly symmetric (logs of lengths, logits of shares).  Per
class, count, mean and second moments are summed in Spark over all training
rows, so the driver receives one small matrix per class.  The class
covariances are shrunk towards the pooled covariance and its diagonal; their
Cholesky factors are computed once and shipped with the scorer.  A text's
score is the logistic of the difference of the two log densities
(Mahalanobis distances through the factors, plus log determinants and log
priors).

Only the text enters a score; labels are used from the training rows alone.

Edge cases: NULL and empty texts have well-defined statistics (all counts 0)
and get a score; NULL label values and labels without a document are ignored;
repeated label rows count repeatedly; if a class has no training row its
Gaussian is the pooled one, and with no training rows at all the score is
0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import SPACED, check_mod, pieces, table, text_bytes, tokenize, written

POOL = 0.1  # shrinkage of a class covariance towards the pooled one
RIDGE = 0.02  # shrinkage towards the pooled diagonal
ACCEPT = 0.7

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "sd_word", "upper", "digit", "symbol", "punct", "pipe",
    "distinct_words", "repeat_next", "capital_words", "lines_per_word", "words_with_symbol", "top_gap",
    "non_ascii",
)

# Fixed byte classes.
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?'\"()-"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL = ~(_LETTER | _DIGIT | _PUNCT)
_SYMBOL[[9, 10, 11, 12, 13, 32]] = False


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Logit of a share, kept finite by half a count."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics(texts: pa.Array) -> np.ndarray:
    """(texts, statistics) matrix; whole texts, no sampling."""
    raw, offs = text_bytes(texts)
    t = tokenize(texts, SPACED)
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    words = np.diff(t.first).astype(float)
    length = (t.end - t.start).astype(np.int64)
    some = np.maximum(words, 1)
    mean = _per_doc(length, t.first) / some
    var = np.maximum(_per_doc(length**2, t.first) / some - mean**2, 0)
    doc = t.doc
    same_doc = doc[1:] == doc[:-1]
    repeats = np.bincount(doc[1:][(t.hash[1:] == t.hash[:-1]) & same_doc], minlength=n).astype(float)
    order = np.lexsort((t.hash, doc))
    h, d = t.hash[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(d[new], minlength=n).astype(float)
    # Share of words that begin with a capital; words that carry a symbol.
    capital = np.bincount(doc[_UPPER[raw[t.start]]] if len(t) else doc, minlength=n).astype(float)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[raw], dtype=np.int64)])
    marked = np.bincount(doc[symbols[t.end] > symbols[t.start]] if len(t) else doc, minlength=n).astype(float)
    # Runs: distances at which the same word comes again (2..40 words back).
    again = np.zeros(n)
    if len(h) > 1:
        at = np.arange(len(t))[order]
        near = ~new[1:] & (np.diff(at) <= 40) & (np.diff(at) > 1)
        again = np.bincount(d[1:][near], minlength=n).astype(float)
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(np.sqrt(var)),
        _share(_per_doc(_UPPER[raw], offs), size), _share(_per_doc(_DIGIT[raw], offs), size),
        _share(_per_doc(_SYMBOL[raw], offs), size), _share(_per_doc(_PUNCT[raw], offs), size),
        _share(_per_doc(raw == ord("|"), offs), size), _share(distinct, words), _share(repeats, words),
        _share(capital, words), _share(_per_doc(raw == 10, offs), words), _share(marked, words),
        _share(again, words), _share(_per_doc(raw >= 128, offs), size),
    ])


def stats_column(text: Column) -> Column:
    """The statistics of each text as an array column."""

    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        x = np.concatenate([statistics(texts[a:b]) for a, b in pieces(texts)] or [np.zeros((0, len(STATISTICS)))])
        starts = np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(x.ravel()))

    return stats(text)


@dataclass(frozen=True)
class Model:
    means: np.ndarray  # (2, k)
    whiten: np.ndarray  # (2, k, k): inverse Cholesky factors
    constant: np.ndarray  # (2,): log prior minus half the log determinant


def _moments(batches):
    """Per class: count, sums and upper-triangular products, one row per task."""
    total: dict[int, np.ndarray] = {}
    k = len(STATISTICS)
    for b in batches:
        y = b.column(0).to_numpy(zero_copy_only=False)
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        for c in np.unique(y).tolist():
            z = x[y == c]
            m = np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
            total[c] = total.get(c, 0) + m
    for c, m in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([m.tolist()], pa.list_(pa.float64()))],
                                         names=["y", "m"])


def fit(rows: DataFrame) -> Model | None:
    """From (y int, x array<double>): the shrunken Gaussians of both classes."""
    k = len(STATISTICS)
    parts = rows.select("y", "x").mapInArrow(_moments, "y int, m array<double>")
    # Added up by position in Spark: the driver gets 2 x (1 + k + k*k) numbers.
    sums = parts.select("y", F.posexplode("m")).groupBy("y", "pos").agg(F.sum("col").alias("s")).collect()
    m = np.zeros((2, 1 + k + k * k))
    for r in sums:
        if r["y"] in (0, 1):
            m[r["y"], r["pos"]] = r["s"]
    n = m[:, 0]
    if n.sum() == 0:
        return None
    mean = np.empty((2, k))
    cov = np.empty((2, k, k))
    pooled_mean = m[:, 1 : 1 + k].sum(0) / n.sum()
    total_cov = m[:, 1 + k :].sum(0).reshape(k, k) / n.sum() - np.outer(pooled_mean, pooled_mean)
    for c in (0, 1):
        if n[c]:
            mean[c] = m[c, 1 : 1 + k] / n[c]
            cov[c] = m[c, 1 + k :].reshape(k, k) / n[c] - np.outer(mean[c], mean[c])
        else:
            mean[c], cov[c] = pooled_mean, total_cov
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    ridge = np.diag(np.diag(pooled) + 1e-3)
    whiten, constant = np.empty((2, k, k)), np.empty(2)
    for c in (0, 1):
        # Few rows: lean more on the pooled covariance.
        pool = max(POOL, k / (k + n[c]))
        s = (1 - RIDGE) * ((1 - pool) * cov[c] + pool * pooled) + RIDGE * ridge
        factor = np.linalg.cholesky(s)
        whiten[c] = np.linalg.inv(factor)
        constant[c] = np.log((n[c] + 1) / (n.sum() + 2)) - np.log(np.diag(factor)).sum()
    return Model(mean, whiten, constant)


def posterior(model: Model | None, x: np.ndarray) -> np.ndarray:
    """P(class 1) of each row of statistics."""
    if model is None:
        return np.full(len(x), 0.5)
    log = [model.constant[c] - 0.5 * (((x - model.means[c]) @ model.whiten[c].T) ** 2).sum(1) for c in (0, 1)]
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def scored(stats: DataFrame, model: Model | None) -> DataFrame:
    """``stats`` (with its array column ``x``) with the column ``score``."""
    k = len(STATISTICS)

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(posterior(model, x.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)))

    return stats.withColumn("score", score("x"))


def training(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, x) of the labelled rows that learning may use."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(check_mod(F.col("doc_id"), 4) != 2)
    known = known.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("y"))
    return stats.join(known, F.col("doc_id") == F.col("_id")).select("y", "x")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    stats = written(docs.select("doc_id", stats_column(F.col("text")).alias("x")), "quality-stats")
    model = fit(training(stats, table(spark, sf_dir, "labels")))
    return scored(stats, model).select(
        "doc_id", (check_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
