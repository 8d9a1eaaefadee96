"""Shared helpers: input tables, written intermediates, and token arrays.

Token helpers work on whole Arrow string arrays: a batch of texts is one byte
buffer, words are byte ranges found with boolean masks, and a word's identity
is a 64-bit hash of its (lower-cased) bytes.  No per-token Python runs.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.session import scratch_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    return scratch_folder(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on the bytes of an Arrow batch (64 MB by
    default) to BATCH_BYTES: several thousand long texts in one batch are held
    by the JVM and the worker at once.  A smaller bound is left as it is."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES or int(now) <= 0:
        spark.conf.set(key, str(BATCH_BYTES))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z only; other letters stay as they are."""
    return F.translate(c, UPPER, UPPER.lower())


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def check_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (NULL ids count as '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


# --- token arrays ---------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes that belong to a word.  SPACED: everything but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ALNUM: digits, a-z (after lower-casing) and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(n, np.uint64(base), dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; NULL texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offs, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


@dataclass
class Tokens:
    """Words of a batch: ``hash[i]`` covers bytes ``start[i]:end[i]``;
    words of document ``d`` are ``first[d]:first[d+1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    lowered: np.ndarray

    def __len__(self) -> int:
        return len(self.hash)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_PIECE = 1 << 20


def word_ranges(low: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(low)
    inside = classes[low]
    edge = np.zeros(n + 1, dtype=bool)  # a document border cuts words
    edge[offs] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end


def tokenize(texts: pa.Array, classes: np.ndarray) -> Tokens:
    """Words of each text as hashes of their lower-cased bytes."""
    raw, offs = text_bytes(texts)
    low = _LOWER[raw]
    start, end = word_ranges(low, offs, classes)
    out = np.empty(len(start), np.uint64)
    # The polynomial prefix sums restart every piece of whole words, so the
    # power tables stay small whatever the batch size.
    at = 0
    while at < len(start):
        b0 = start[at]
        to = max(at + 1, int(np.searchsorted(end, b0 + _PIECE, side="right")))
        part = low[b0 : end[to - 1]].astype(np.uint64) + np.uint64(1)
        n = len(part) + 1
        # At least a whole piece, so that the table is built once per worker.
        up, down = _powers(_BASE, max(n, _PIECE + 1)), _powers(_BASE_INV, max(n, _PIECE + 1))
        sums = np.zeros(n, np.uint64)
        np.cumsum(part * up[: n - 1], out=sums[1:])
        s, e = start[at:to] - b0, end[at:to] - b0
        out[at:to] = mix64((sums[e] - sums[s]) * down[s])
        at = to
    first = np.searchsorted(start, offs, side="left")
    return Tokens(out, start, end, first, offs, low)


def hash_word(word: str) -> int:
    """The token hash of one word (for small vocabularies and tests)."""
    t = tokenize(pa.array([word]), np.ones(256, dtype=bool))
    return int(t.hash[0])


PIECE_BYTES = 1 << 20  # text handled at once inside a column function


def pieces(texts: pa.Array, limit: int = PIECE_BYTES):
    """(start, stop) of consecutive rows with about ``limit`` bytes of text;
    a longer text is a piece of its own.  Bounds the arrays of a batch."""
    offs = text_bytes(texts)[1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield at, to
        at = to


def gathered(batches, limit: int):
    """Join small Arrow batches of (id..., text) up to ``limit`` text bytes."""
    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        at = 0
        texts = b.column(b.schema.get_field_index("text"))
        lengths = np.diff(text_bytes(texts)[1])
        while at < b.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), max(limit - size, 1), side="right")
            take = max(1, int(room)) if not held or room else 0
            if take:
                held.append(b.slice(at, take))
                size += int(lengths[at : at + take].sum())
                at += take
            if size >= limit or (at < b.num_rows and held):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
