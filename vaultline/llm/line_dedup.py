"""Line dedup over an incremental, reversible line index.

``LineIndex`` keeps, under one folder,

* ``refs``: the exact reference log, one row per line of a batch (key,
  document, position) with ``n = +1`` (inserted) or ``-1`` (deleted);
* ``counts``: per key that a batch touched its number of references, smallest
  and largest document since; the latest row of a key holds;
* ``filters``: one cuckoo filter per shard of the key space, holding the
  fingerprint of every key with references.

``insert`` reduces a batch to one row per key before anything is routed to a
shard (a line held by a third of all documents is one row per map task), asks
the shard's filter whether the key may be stored, and looks only those keys up
in the exact counts.  ``delete`` subtracts the documents' references, recounts
only their keys, and takes keys that reached zero out of the filters, so a
deletion undoes an insertion exactly.  Filters can only say "maybe" wrongly;
every decision rests on the exact tables.  There are as many shards as keep a
filter at ``SHARD_KEYS`` keys or less; when an index outgrows them, they are
dealt anew from the counts.

Every line is split, stripped and hashed once: the log has the lines' positions,
so the result joins the log, not the texts, with the shared keys.  Keys that hold
more than one in ``SPREAD`` references (fewer than ``SPREAD`` keys) meet their
references by broadcast, the others by a shuffle of parts of even size.

A line's key: the line stripped of ASCII white space with A-Z lower-cased;
lines whose key is shorter than ``min_chars`` code points are never touched.

Edge cases: a NULL or empty text is one empty line; rows with a NULL id are
no documents (they are not counted and keep all their lines); rows of one id are
one document, also with different texts: its lines are shared only if another
id has them, and each text loses its own lines; an empty table leaves an empty
index and result.  Columns of the input named like the result's (``n_lines``,
``n_dropped``) are replaced, all others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import cuckoo
from vaultline.llm.common import lower_ascii, new_folder, table, text_or_empty, written

MIN_CHARS = 10
SHARD_KEYS = 1 << 18
LEAST_SHARDS = 16
SPREAD = 1024
_SPACE = " \t\n\x0b\x0c\r"


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def text_id(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text)


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_id, pos, key) of every line long enough to count; key is
    the md5 of the stripped, lower-cased line.

    The work is done on the array of lines: stripped once, short ones dropped
    (lowering A-Z keeps the length), the rest hashed once.  Nothing of it can be
    pushed below the explode and so evaluated twice."""
    stripped = F.transform(text_lines(text_or_empty()), lambda x, i: F.struct(
        i.alias("pos"), F.btrim(x, F.lit(_SPACE)).alias("line")))
    long = F.filter(stripped, lambda s: F.length(s["line"]) >= min_chars)
    keyed = F.transform(long, lambda s: F.struct(
        s["pos"].alias("pos"), F.unhex(F.md5(lower_ascii(s["line"]).cast("binary"))).alias("key")))
    return docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", text_id(text_or_empty()).alias("text_id"), F.inline(keyed))


def _key_array(keys: pa.ChunkedArray) -> np.ndarray:
    """First 8 bytes of each md5 key as uint64."""
    fixed = pa.concat_arrays([c.cast(pa.binary(16)) for c in keys.chunks]) if keys.num_chunks else pa.array([], pa.binary(16))
    if not len(fixed):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(fixed.buffers()[1], np.uint8)[fixed.offset * 16 : (fixed.offset + len(fixed)) * 16]
    return np.ascontiguousarray(data.reshape(-1, 16)[:, :8]).view(">u8").ravel().astype(np.uint64)


_COUNTS = "key binary, n_refs long, owner long, last long"
_FILTER = "shard int, n_keys long, slots binary"


def _probe(left: pa.Table, right: pa.Table) -> pa.Table:
    maybe = np.zeros(left.num_rows, dtype=bool)
    if left.num_rows and right.num_rows:
        maybe = cuckoo.contains(cuckoo.load(right.column("slots")[0].as_py()), _key_array(left.column("key")))
    return left.drop_columns(["shard"]).append_column("maybe", pa.array(maybe))


def _updater(insert: bool):
    def update(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = (left if left.num_rows else right).column("shard")[0].as_py()
        old = cuckoo.load(right.column("slots")[0].as_py()) if right.num_rows else None
        n = right.column("n_keys")[0].as_py() if right.num_rows else 0
        keys = _key_array(left.column("key"))
        if insert:
            n += len(keys)
            slots = cuckoo.insert(old, keys, n)
        else:
            n -= len(keys)
            slots = cuckoo.remove(old, keys) if old is not None else None
        # No room: the caller rebuilds this shard from the counts.
        data = None if slots is None else cuckoo.dump(slots)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n_keys": pa.array([n], pa.int64()),
                         "slots": pa.array([data], pa.binary())})

    return update


class LineIndex:
    """Incremental line index in ``folder`` (default: a fresh scratch folder)."""

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int | None = None,
                 min_chars: int = MIN_CHARS):
        self.spark, self.shards, self.min_chars = spark, shards, min_chars
        self.folder = folder or new_folder(spark, "line-index")
        self.batch, self.deletions = 0, 0

    # -- stored tables --
    def _path(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/batch={batch:06d}"

    def _read(self, name: str, batches) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/{name}").parquet(
            *[self._path(name, b) for b in batches])

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def refs(self, until: int | None = None) -> DataFrame:
        """The exact log of all batches so far: (key, doc_id, text_id, pos, n)."""
        return self._read("refs", range(1, (self.batch if until is None else until) + 1)).drop("batch")

    def live(self, refs: DataFrame) -> DataFrame:
        """References that were not deleted, with how often they are held."""
        if not self.deletions:
            return refs
        return refs.groupBy("key", "doc_id", "text_id", "pos").agg(F.sum("n").alias("n")).filter("n > 0")

    def counts(self) -> DataFrame:
        """The latest (key, n_refs, owner, last) of every key."""
        if not self.batch:
            return self.spark.createDataFrame([], _COUNTS)
        rows = self._read("counts", range(1, self.batch + 1))
        return rows.groupBy("key").agg(*[F.max_by(c, "batch").alias(c) for c in ("n_refs", "owner", "last")])

    def filters(self) -> DataFrame:
        return self._read("filters", [self.batch]).select("shard", "n_keys", "slots")

    def shared(self) -> DataFrame:
        """(key, n_refs, owner) of every key now in at least two documents."""
        return self.counts().filter("n_refs > 0 AND owner <> last").select("key", "n_refs", "owner")

    # -- changes --
    def _log(self, docs: DataFrame, n: int) -> DataFrame:
        path = self._path("refs", self.batch + 1)
        keyed_lines(docs, self.min_chars).select("key", "doc_id", "text_id", "pos", F.lit(n).alias("n")).write.parquet(path)
        return self.spark.read.parquet(path)

    @staticmethod
    def _counted(refs: DataFrame) -> DataFrame:
        """(key, n_refs, owner, last): one row per key and map task is shuffled."""
        return refs.groupBy("key").agg(
            F.sum("n").alias("n_refs"), F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))

    def _filtered(self, keys: DataFrame, stored: DataFrame, insert: bool) -> DataFrame:
        return keys.select(self._shard(), "key").groupBy("shard").cogroup(stored.groupBy("shard")).applyInArrow(
            _updater(insert), _FILTER)

    def _write_filters(self, changed: DataFrame, insert: bool) -> None:
        """The filters after the batch whose counts are written already."""
        empty = self.spark.createDataFrame([], _FILTER)
        updated = written(self._filtered(changed, self.filters() if self.batch else empty, insert), "line-filters")
        state = updated.agg(F.sum("n_keys").alias("keys"), F.count_if(F.col("slots").isNull()).alias("full")).first()
        self.batch += 1
        keys = self.counts().filter("n_refs > 0").select("key")
        if (state.keys or 0) > SHARD_KEYS * self.shards:
            while state.keys > SHARD_KEYS * self.shards:
                self.shards *= 2
            updated = self._filtered(keys, empty, True)
        elif state.full:
            crowded = updated.filter("slots IS NULL").select(F.col("shard").alias("s"))
            again = self._filtered(keys.join(crowded, self._shard() == F.col("s"), "left_semi"), empty, True)
            updated = updated.filter("slots IS NOT NULL").unionByName(again)
        updated.write.parquet(self._path("filters", self.batch))

    def insert(self, docs: DataFrame) -> None:
        """Add the documents' lines; documents must not be stored already."""
        keys = self._counted(self._log(docs, 1))
        out = self._path("counts", self.batch + 1)
        if not self.batch:
            keys.write.parquet(out)
            new = self.spark.read.parquet(out).select("key")
            if self.shards is None:
                self.shards = max(LEAST_SHARDS, -(-2 * new.count() // SHARD_KEYS))
        else:
            probed = written(
                keys.select(self._shard(), "*").groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInArrow(
                    _probe, f"{_COUNTS}, maybe boolean"), "line-probe")
            maybe = probed.filter("maybe").drop("maybe")
            old = self._read("counts", range(1, self.batch + 1)).join(maybe.select("key"), "key", "left_semi").groupBy(
                "key").agg(*[F.max_by(c, "batch").alias(f"old_{c}") for c in ("n_refs", "owner", "last")])
            looked = written(maybe.join(old.filter("old_n_refs > 0"), "key", "left").select(
                "key", (F.col("n_refs") + F.coalesce("old_n_refs", F.lit(0))).alias("n_refs"),
                F.least("owner", "old_owner").alias("owner"), F.greatest("last", "old_last").alias("last"),
                F.col("old_n_refs").isNotNull().alias("stored")), "line-looked")
            fresh = probed.filter("NOT maybe").drop("maybe")
            fresh.unionByName(looked.drop("stored")).write.parquet(out)
            new = fresh.select("key").unionByName(looked.filter("NOT stored").select("key"))
        self._write_filters(new, insert=True)

    def delete(self, docs: DataFrame) -> None:
        """Take the documents' lines out again (their texts as inserted)."""
        if not self.batch:
            return
        log = self._log(docs, -1)
        self.deletions += 1
        keys = log.select("key").distinct()
        held = self.live(self.refs(self.batch + 1).join(keys, "key", "left_semi"))
        now = written(keys.join(self._counted(held), "key", "left").select(
            "key", F.coalesce("n_refs", F.lit(0)).alias("n_refs"), "owner", "last"), "line-recount")
        now.write.parquet(self._path("counts", self.batch + 1))
        self._write_filters(now.filter("n_refs = 0").select("key"), insert=False)

    # -- result --
    def dropped(self, docs: DataFrame | None = None) -> DataFrame:
        """(doc_id, text_id, positions): the lines that another document owns, of
        the indexed documents or (also of others) of ``docs``."""
        lines = self.live(self.refs()) if docs is None else keyed_lines(docs, self.min_chars)
        lines = lines.select("key", "doc_id", "text_id", "pos")
        shared = written(self.shared(), "line-shared")
        total = shared.agg(F.sum("n_refs")).first()[0] or 0
        # Fewer than SPREAD keys hold more than total/SPREAD references each.
        hot = F.broadcast(shared.filter(F.col("n_refs") * SPREAD > total).select("key", F.col("owner").alias("hot_owner")))
        marked = lines.join(hot, "key", "left")
        rest = shared.filter(F.col("n_refs") * SPREAD <= total).select("key", "owner")
        hits = marked.filter("hot_owner IS NOT NULL AND hot_owner <> doc_id").unionByName(
            marked.filter("hot_owner IS NULL").join(rest, "key").filter("owner <> doc_id"), allowMissingColumns=True)
        return hits.groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("positions"))

    def dedup(self, docs: DataFrame, indexed: bool = True) -> DataFrame:
        """``docs`` with ``text`` rebuilt from the lines that stay, plus
        ``n_lines`` (before) and ``n_dropped``.  ``indexed`` documents are looked
        up in the log by id and text."""
        drop = self.dropped(None if indexed else docs).select(
            F.struct("doc_id", "text_id").alias("_drop"), "positions")
        kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "text")]
        d = docs.select(F.struct(*kept).alias("row"), "text", F.struct(
            "doc_id", text_id(text_or_empty()).alias("text_id")).alias("at")).join(
            drop, (F.col("at.doc_id") == F.col("_drop.doc_id")) & (F.col("at.text_id") == F.col("_drop.text_id")), "left")
        parts = text_lines(text_or_empty())
        n = F.size(parts)
        keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("positions"))
        text = F.when(F.col("positions").isNull(), text_or_empty()).otherwise(
            F.array_join(F.transform(keep, lambda i: F.get(parts, i)), "\n"))
        columns = [text.alias("text") if c == "text" else F.col("row")[c].alias(c)
                   for c in docs.columns if c not in ("n_lines", "n_dropped")]
        return d.select(*columns, n.cast("long").alias("n_lines"),
                        F.when(F.col("positions").isNull(), 0).otherwise(F.size("positions")).cast("long").alias("n_dropped"))


def build(docs: DataFrame, batches: int = 2, folder: str | None = None) -> LineIndex:
    """An index of ``docs`` filled in ``batches`` arrivals (split by id hash)."""
    index = LineIndex(docs.sparkSession, folder)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for b in range(batches):
        index.insert(docs.select("doc_id", "text").filter(part == b))
    return index


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = build(docs).dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS owner FROM keyed
  WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.line, k.pos, s.owner IS NOT NULL AND s.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN shared s ON s.key = k.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
