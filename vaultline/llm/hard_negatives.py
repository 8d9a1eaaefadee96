"""Hard-negative mining by coordinate pruning over length buckets.

For each anchor the first ``positives`` rows of its label by inner product and
then, for each of those, the first ``negatives`` rows of other labels whose
score lies between ``low`` and ``high`` per cent of the positive's.

Rows become integer vectors, written once in falling order of length (a range
partitioning by length and id, so equal lengths are split too).  Anchors are
the queries: they are dealt by hash into blocks of at most about ``BLOCK``
entries, and each block is searched against all rows in two passes.  A task
takes its rows in buckets of similar length.  For a query q with the least
score t that still counts, a bucket of largest length l is skipped if |q|*l < t.
Otherwise, with c = t/(|q|*l), a unit vector p of the bucket can reach t only if
every coordinate f lies within q_f*c +- sqrt((1-q_f^2)(1-c^2)) (q as unit
vector; up to 1 if q_f >= c, down to -1 if q_f <= -c).  The ranges of the query's largest (focus) coordinates are looked up in
sorted coordinate lists, the candidates of the shortest list are intersected
with the other ranges, and what is left is scored exactly in integers.  Where
the ranges leave most of a bucket, pruning costs more than it saves, and the
bucket is scored as a whole.  t rises as results fill up; it starts from an
exact search of ``PILOT`` hashed rows (any subset gives a valid bound, so the
result does not depend on it) and from the positives' scores.

Only each task's best few rows per query leave it; a window takes the first
few of those.

Edge cases: rows with a NULL id, label or vector, or with NULL, NaN or infinite
entries take no part; missing entries of shorter vectors count as 0.  Rows with
the anchor's own id are never its positives or negatives; exact repeats of an
anchor count once, rows sharing an id with another vector or label are rows of
their own, but of those with equal scores one is listed.  Fewer partners
than asked for are all returned; an empty table gives no rows.  Other columns
of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.llm.common import new_folder, table, written
from vaultline.llm.vectors import exact_products, list_array, matrix, scaled

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
BUCKET = 2048  # rows of a length bucket
FOCUS = 3  # focus coordinates of a query
BLOCK = 1 << 21  # anchor entries collected and sent to workers at once (16 MB)
PILOT = 4096
_CELLS = 1 << 20  # scores held at once
_SLACK = 1e-9  # widens ranges against rounding: never loses a row

_ROWS = "vec_id long, label long, dim int, length double, x array<int>"
_FOUND = "target long, score long, vec_id long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, "
          "positive_score long, negative_score long")


def _integers(batches):
    for b in batches:
        usable, lengths, values = scaled(b.column("embedding"))
        row = np.repeat(np.arange(len(lengths)), lengths)
        length = np.sqrt(np.bincount(row, values.astype(np.float64) ** 2, minlength=len(lengths)))
        keep = pa.array(usable)
        yield pa.RecordBatch.from_arrays(
            [b.column("vec_id").filter(keep), b.column("label").filter(keep),
             pa.array(lengths.astype(np.int32)), pa.array(length), list_array(lengths, values)],
            names=["vec_id", "label", "dim", "length", "x"])


class Queries:
    """A block of anchors and, per anchor, its open score windows."""

    def __init__(self, ids, labels, x):
        self.ids, self.labels, self.x = ids, labels, x
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        safe = np.where(self.length > 0, self.length, 1)[:, None]
        self.unit = x / safe
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        # (anchors x windows): least and largest score that counts.
        self.low = np.full((len(ids), 1), np.iinfo(np.int64).min)
        self.high = np.full((len(ids), 1), np.iinfo(np.int64).max)

    def windows(self, low, high) -> "Queries":
        self.low, self.high = low, high
        return self


def _firsts(target, score, ids, k):
    """The first ``k`` (score falling, id rising) of each target, repeats out."""
    order = np.lexsort((ids, -score, target))
    target, score, ids = target[order], score[order], ids[order]
    new = np.ones(len(target), dtype=bool)
    new[1:] = (target[1:] != target[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
    target, score, ids = target[new], score[new], ids[new]
    starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, int)
    rank = np.arange(len(target)) - np.repeat(starts, np.diff(np.append(starts, len(target))))
    keep = rank < k
    return target[keep], score[keep], ids[keep]


class Bucket:
    """Rows of similar length, the longest first, with sorted coordinate lists."""

    def __init__(self, ids, labels, length, x):
        order = np.argsort(-length, kind="stable")
        self.ids, self.labels, self.length, self.x = ids[order], labels[order], length[order], x[order]
        self.unit = self.x / np.where(self.length > 0, self.length, 1)[:, None]
        self.least, self.most = self.unit.min(axis=0), self.unit.max(axis=0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, values) of one coordinate, in order of the values."""
        if f not in self._lists:
            rows = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = rows, self.unit[rows, f]
        return self._lists[f]

    def candidates(self, q: Queries, who: np.ndarray, least: np.ndarray):
        """Yields (anchors, rows or None): rows that can reach the anchors'
        ``least`` scores; None stands for the whole bucket."""
        reach = q.length[who] * self.length[0] * (1 + _SLACK)
        can = (least <= reach) | (least <= 0)
        who, least, reach = who[can], least[can], reach[can]
        c = np.where(reach > 0, np.maximum(least, 0) / np.where(reach > 0, reach, 1), 0)
        c = np.minimum(c, 1)
        focus = q.focus[who]
        qf = np.take_along_axis(q.unit[who], focus, axis=1)
        half = np.sqrt(np.maximum(0, (1 - qf**2) * (1 - c[:, None] ** 2)))
        from_ = np.where(qf <= -c[:, None], -1, qf * c[:, None] - half) - 1e-7
        to = np.where(qf >= c[:, None], 1, qf * c[:, None] + half) + 1e-7
        open_ = ((from_ <= self.least[focus]) & (to >= self.most[focus])).all(axis=1) | (least <= 0)
        whole = [who[open_]]
        sharp = np.flatnonzero(~open_)
        if len(sharp):
            starts, ends = np.empty((len(sharp), focus.shape[1]), int), np.empty((len(sharp), focus.shape[1]), int)
            for f in np.unique(focus[sharp]):
                at = np.nonzero(focus[sharp] == f)
                values = self.coordinate(f)[1]
                starts[at] = np.searchsorted(values, from_[sharp][at], "left")
                ends[at] = np.searchsorted(values, to[sharp][at], "right")
            size = ends - starts
            best = size.argmin(axis=1)
            few = size[np.arange(len(sharp)), best] * 4 < len(self.ids)
            whole.append(who[sharp[~few]])
            for i in np.flatnonzero(few):
                a, b = sharp[i], best[i]
                rows = self.coordinate(focus[a, b])[0][starts[i, b] : ends[i, b]]
                values = self.unit[rows][:, focus[a]]
                rows = rows[((values >= from_[a]) & (values <= to[a])).all(axis=1)]
                if len(rows):
                    yield who[a : a + 1], rows
        whole = np.concatenate(whole)
        step = max(1, _CELLS // len(self.ids))
        for at in range(0, len(whole), step):
            yield whole[at : at + step], None


def searched(q: Queries, same: bool, k: int, dim: int):
    """A map over row batches: the first ``k`` rows of each open window, with
    the label of the anchor (``same``) or another one."""
    def search(batches):
        low, high = q.low.copy(), q.high
        windows = low.shape[1]
        best = (np.zeros(0, np.int64),) * 3
        held, n_held = [], 0

        def settle():
            nonlocal best, held, n_held
            if held:
                best = _firsts(*(np.concatenate([b, *parts]) for b, parts in zip(best, zip(*held))), k)
                target, score, _ = best
                full = np.flatnonzero(np.bincount(target, minlength=low.size) >= k)
                last = np.searchsorted(target, full, side="right") - 1
                low.reshape(-1)[full] = np.maximum(low.reshape(-1)[full], score[last])
                held, n_held = [], 0

        for b in batches:
            ids, labels = (b.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            length, x = b.column("length").to_numpy(zero_copy_only=False), matrix(b.column("x"), dim)
            order = np.argsort(-length, kind="stable")
            for at in range(0, len(order), BUCKET):
                part = order[at : at + BUCKET]
                bucket = Bucket(ids[part], labels[part], length[part], x[part])
                least = low.min(axis=1)
                who = np.flatnonzero((low <= high).any(axis=1))
                for anchors, rows in bucket.candidates(q, who, least[who]):
                    rows = np.arange(len(bucket.ids)) if rows is None else rows
                    scores = exact_products(q.x[anchors], bucket.x[rows].T)
                    fits = (q.labels[anchors][:, None] == bucket.labels[rows][None, :]) == same
                    fits &= q.ids[anchors][:, None] != bucket.ids[rows][None, :]
                    fits &= scores >= least[anchors][:, None]
                    a, r = np.nonzero(fits)
                    s, who_a, ids_r = scores[a, r], anchors[a], bucket.ids[rows[r]]
                    for j in range(windows):
                        inside = (s >= low[who_a, j]) & (s <= high[who_a, j])
                        held.append((who_a[inside] * windows + j, s[inside], ids_r[inside]))
                        n_held += int(inside.sum())
                    if n_held >= _CELLS:
                        settle()
                settle()
        target, score, ids = best
        yield pa.RecordBatch.from_arrays([pa.array(target), pa.array(score), pa.array(ids)],
                                         names=["target", "score", "vec_id"])

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per target of what the tasks found: (target, score, vec_id, rank)."""
    w = Window.partitionBy("target").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    rows = df.select(*names).toArrow()
    return [rows.column(n).to_numpy() for n in names]


def mine(df: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of the rows of ``df`` (vec_id, label, embedding) for
    which ``is_anchor``, an expression over ``vec_id``, holds; see ``RESULT``."""
    spark = df.sparkSession
    usable = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       "embedding").filter("vec_id IS NOT NULL AND label IS NOT NULL")
    rows = written(
        usable.mapInArrow(_integers, _ROWS).repartitionByRange(F.col("length").desc(), F.col("vec_id"))
        .sortWithinPartitions(F.col("length").desc(), F.col("vec_id")), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    dim = size.dim or 0
    picked = written(rows.filter(is_anchor).select("vec_id", "label", "x").distinct(), "negatives-anchors")
    n_blocks = -(-picked.count() * max(dim, 1) // BLOCK)
    out = new_folder(spark, "negatives")
    pilot = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, size.n // PILOT))) == 0)
    for block in range(n_blocks):
        mine_ = picked.filter(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(n_blocks)) == block)
        anchors = mine_.toArrow().combine_chunks()
        if not anchors.num_rows:
            continue
        x = anchors.column("x").combine_chunks()
        q = Queries(anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), matrix(x, dim))
        if size.n > 2 * PILOT:
            target, score, rank = _columns(
                _top(pilot.mapInArrow(searched(q, True, positives, dim), _FOUND), positives), "target", "score", "rank")
            known = rank == positives
            q.low[target[known], 0] = score[known]
        # At most anchors of the block x positives rows come back.
        a, score, pid = _columns(
            _top(rows.mapInArrow(searched(q, True, positives, dim), _FOUND), positives), "target", "score", "vec_id")
        # One window per anchor and distinct positive score.
        slots = np.unique(np.column_stack([a, score]), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        first = np.searchsorted(slots[:, 0], slots[:, 0])
        slot = np.arange(len(slots)) - first
        shape = (len(q.ids), int(slot.max(initial=0)) + 1)
        least, most = np.full(shape, np.iinfo(np.int64).max), np.full(shape, np.iinfo(np.int64).min)
        s = slots[:, 1]
        least[slots[:, 0], slot] = -(-low * s // 100)
        most[slots[:, 0], slot] = high * s // 100
        where = {(int(i), int(v)): int(i) * shape[1] + int(j) for (i, v), j in zip(slots, slot)}
        asked = pa.table({
            "target": pa.array([where[int(i), int(v)] for i, v in zip(a, score)], pa.int64()),
            "anchor_id": pa.array(q.ids[a]), "positive_id": pa.array(pid), "positive_score": pa.array(score)})
        found = _top(rows.mapInArrow(searched(q.windows(least, most), False, negatives, dim), _FOUND), negatives)
        spark.createDataFrame(asked).join(found, "target").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.parquet(f"{out}/block={block:06d}")
    if not n_blocks:
        return spark.createDataFrame([], RESULT)
    return spark.read.parquet(out).drop("block")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; where the id is divisible by
    seven, the label is first set to the next one of ten."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, p.vec_id, p.label = a.label AS same,
         list_inner_product(a.x, p.x)::BIGINT AS score
  FROM r a JOIN r p ON a.vec_id % 100 = 0 AND p.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
         n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positives p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
