"""Interpolated modified Kneser-Ney language model (bigrams).

Counting runs in Spark; the model is a folder of sorted arrays on shared
storage that workers memory-map:

* the vocabulary: per word shard the sorted 64-bit word hashes and counts; a
  word's number is its shard's offset plus its place in the array;
* the bigrams: per bigram shard the sorted keys ``context << 32 | word`` and
  their counts;
* per word shard, aligned with the vocabulary: the mass a context leaves to
  the lower order, and the word's continuation count.

Words and bigrams are dealt to shards by hash, so a frequent word's bigrams
are spread over all shards and no context is gathered in one place.  What map
tasks send to the shards is already reduced: the sorted distinct keys of a
few million tokens with their counts, delta-coded.

A scoring task numbers its words by binary search in the mapped vocabulary,
looks the distinct bigrams of a chunk up shard by shard in sorted order, and
sums log probabilities per text, all in arrays.  Workers of one node share
the mapped pages.

The model: P(w|v) = max(c(vw) - D, 0) / c(v) + g(v) P1(w), with discounts
D1, D2, D3+ from the counts of counts and g(v) the discounted mass of v;
P1 is the same over continuation counts (distinct left neighbours), ending in
a uniform distribution over the vocabulary and the unknown word.  Texts begin
with a start context and end with an end token that is counted.

Edge cases: NULL and empty texts are the end token alone; an unknown word is
scored as unknown and is a context without counts (P1 alone); without any
training text every token has the uniform probability 1; repeated rows and
NULL ids train and score like others (ids count as '' for the held-out split).
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import SPACED, check_mod, gathered, mix64, new_folder, table, text_or_empty, tokenize

MIN_SHARD_BITS = 6
SHARD_BYTES = 16 << 20  # training text per shard, so shards grow in number, not in size
CHUNK_BYTES = 16 << 20  # text per counting chunk
END = np.uint64(0x45D9F3B3335B369)  # hash of the end token (no word hashes are chosen by hand)
_ORDER_BITS = 32  # word numbers fit in 32 bits (checked)


# --- arrays on shared storage ----------------------------------------------


def _local(uri: str) -> str | None:
    """The path of a folder that workers mount, or None for an object store."""
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else None


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of its file system: a path without one belongs
    to the cluster's default, which need not be mounted."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array; the rename makes a retried task harmless."""
    path = _local(folder)
    data = np.ascontiguousarray(array)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        part = os.path.join(path, f".{name}.{uuid.uuid4().hex}")
        data.tofile(part)
        os.replace(part, os.path.join(path, name))
        return
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name}") as out:
        out.write(data.tobytes())


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    """The stored array, memory-mapped where the storage is mounted."""
    path = _local(folder)
    if path is not None:
        full = os.path.join(path, name)
        if os.path.getsize(full) == 0:
            return np.zeros(0, dtype)
        return np.memmap(full, dtype=dtype, mode="r")
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


# --- delta-coded messages ----------------------------------------------------


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct uint64 keys and positive counts in few bytes."""
    n = len(keys)
    deltas = np.diff(keys, prepend=np.uint64(0))
    first = int(deltas[0]) if n else 0
    if n:
        deltas[0] = 0
    width = max(1, (int(deltas.max()).bit_length() + 7) // 8) if n else 1
    body = np.ascontiguousarray(deltas.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<u8")
    head = np.array([n, first, width, len(large)], "<u8")
    return head.tobytes() + body.tobytes() + small.tobytes() + large.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, first, width, more = (int(x) for x in np.frombuffer(data, "<u8", 4))
    body = np.frombuffer(data, np.uint8, n * width, 32).reshape(n, width)
    deltas = np.zeros((n, 8), np.uint8)
    deltas[:, :width] = body
    keys = deltas.view("<u8").ravel().astype(np.uint64)
    if n:
        keys[0] = first
    keys = np.cumsum(keys, dtype=np.uint64)
    counts = np.frombuffer(data, np.uint8, n, 32 + n * width).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", more, 32 + n * width + n).astype(np.int64)
    return keys, counts


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple:
    """Distinct sorted keys with the sums of each value column."""
    if not len(keys):
        return (keys, *[v.astype(np.int64) for v in values])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (keys[start], *[np.add.reduceat(v[order], start) for v in values])


def _merge(messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(x) for x in messages.column("data").to_pylist()]
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _rows(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """One message per shard of sorted keys."""
    order = np.argsort(shards, kind="stable")
    shards, keys, counts = shards[order], keys[order], counts[order]
    start = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else np.zeros(0, int)
    stop = np.r_[start[1:], len(shards)]
    return pa.RecordBatch.from_arrays([
        pa.array(shards[start].astype(np.int32)),
        pa.array([pack(keys[a:b], counts[a:b]) for a, b in zip(start, stop, strict=True)], pa.binary()),
    ], names=["shard", "data"])


def _word_shard(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)  # ranges of the hash


def _pair_shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(keys) >> np.uint64(64 - bits)).astype(np.int64)


# --- text to tokens ----------------------------------------------------------


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the words of each text followed by the end token."""
    t = tokenize(texts, SPACED)
    n = len(t.first) - 1
    first = t.first + np.arange(n + 1)
    out = np.full(len(t) + n, END, np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[first[1:] - 1] = False
    out[inside] = t.hash
    return out, first


def _word_counter(bits: int):
    def run(batches):
        for chunk in gathered(batches, CHUNK_BYTES):
            hashes, _ = sequences(chunk.column("text").combine_chunks())
            words, counts = np.unique(hashes, return_counts=True)
            yield _rows(_word_shard(words, bits), words, counts)

    return run


class Vocabulary:
    """Word numbers from the mapped vocabulary; 0 is the unknown word, the
    start context is number ``size + 1``."""

    def __init__(self, folder: str, sizes: list[int]):
        self.shards = [map_array(folder, f"words-{s:06d}", np.uint64) for s in range(len(sizes))]
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        self.size = int(self.offset[-1])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        words, index = np.unique(hashes, return_inverse=True)
        out = np.zeros(len(words), np.int64)
        n = len(self.shards)  # a power of two: shards are ranges of the hash
        cuts = np.searchsorted(words, np.arange(n, dtype=np.uint64) << np.uint64(65 - n.bit_length()))
        for s, (a, b) in enumerate(zip(cuts, np.r_[cuts[1:], len(words)], strict=True)):
            have = self.shards[s]
            if a < b and len(have):
                at = np.minimum(np.searchsorted(have, words[a:b]), len(have) - 1)
                out[a:b] = np.where(have[at] == words[a:b], self.offset[s] + at + 1, 0)
        return out[index]


@lru_cache(maxsize=2)
def _vocabulary(folder: str, sizes: tuple) -> Vocabulary:
    return Vocabulary(folder, list(sizes))


def _pairs(numbers: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    context = np.empty_like(numbers)
    context[1:] = numbers[:-1]
    context[first[:-1]] = start
    return (context.astype(np.uint64) << np.uint64(_ORDER_BITS)) | numbers.astype(np.uint64)


def _pair_counter(folder: str, sizes: tuple):
    def run(batches):
        vocabulary = _vocabulary(folder, sizes)
        for chunk in gathered(batches, CHUNK_BYTES):
            hashes, first = sequences(chunk.column("text").combine_chunks())
            keys, counts = np.unique(
                _pairs(vocabulary.number(hashes), first, vocabulary.size + 1), return_counts=True)
            yield _rows(_pair_shard(keys, len(sizes).bit_length() - 1), keys, counts)

    return run


# --- shard tasks -------------------------------------------------------------


def _store_words(folder: str):
    def run(messages: pa.Table) -> pa.Table:
        shard = messages.column("shard")[0].as_py()
        words, counts = _merge(messages)
        save_array(folder, f"words-{shard:06d}", words)
        save_array(folder, f"counts-{shard:06d}", counts)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(words)], pa.int64()),
                         "tokens": pa.array([int(counts.sum())], pa.int64())})

    return run


def _store_pairs(folder: str, offsets: tuple):
    """Writes the shard's bigrams; yields its counts of counts and, per word
    shard, what its bigrams add to contexts and to continuations."""

    def run(messages: pa.Table) -> pa.Table:
        shard = messages.column("shard")[0].as_py()
        keys, counts = _merge(messages)
        save_array(folder, f"pairs-{shard:06d}", keys)
        save_array(folder, f"times-{shard:06d}", counts.astype(np.uint32))
        context = (keys >> np.uint64(_ORDER_BITS)).astype(np.int64)
        word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        of_counts = np.bincount(np.minimum(counts, 5), minlength=6)
        rows = {"shard": [], "kind": [], "data": []}
        for kind, (number, value) in enumerate((
            (context, (counts == 1).astype(np.int64)), (context, (counts == 2).astype(np.int64)),
            (context, (counts > 2).astype(np.int64)), (context, counts), (word, np.ones(len(word), np.int64)),
        )):
            some = value > 0
            k, v = summed(number[some], value[some])
            if not len(k):
                continue
            # The start context has no vocabulary entry: a shard of its own.
            part = np.where(k > offsets[-1], len(offsets) - 1, np.searchsorted(offsets, k - 1, side="right") - 1)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(k)], strict=True):
                rows["shard"].append(int(part[a]))
                rows["kind"].append(kind)
                rows["data"].append(pack(k[a:b].astype(np.uint64), v[a:b]))
        rows["shard"].append(-1 - shard)
        rows["kind"].append(9)
        rows["data"].append(of_counts.astype("<i8").tobytes())
        return pa.table({"shard": pa.array(rows["shard"], pa.int32()), "kind": pa.array(rows["kind"], pa.int32()),
                         "data": pa.array(rows["data"], pa.binary())})

    return run


def _store_stats(folder: str, offsets: tuple):
    """Per word shard: the aligned context and continuation counts."""

    def run(messages: pa.Table) -> pa.Table:
        shard = messages.column("shard")[0].as_py()
        if shard < 0:  # counts of counts: passed on
            return pa.table({"shard": pa.array([-1 - shard], pa.int32()), "kind": pa.array([9], pa.int32()),
                             "n": pa.array([np.frombuffer(messages.column("data")[0].as_py(), "<i8").tolist()],
                                           pa.list_(pa.int64()))})
        start = shard == len(offsets) - 1
        base = offsets[-1] + 1 if start else offsets[shard] + 1
        size = 1 if start else offsets[shard + 1] - offsets[shard]
        got = np.zeros((5, size), np.int64)
        kinds = messages.column("kind").to_numpy()
        for kind, data in zip(kinds, messages.column("data").to_pylist(), strict=True):
            k, v = unpack(data)
            np.add.at(got[kind], k.astype(np.int64) - base, v)
        save_array(folder, f"context-{shard:06d}", got[:4].astype(np.uint32))
        save_array(folder, f"left-{shard:06d}", got[4].astype(np.uint32))
        of = np.bincount(np.minimum(got[4][got[4] > 0], 5), minlength=6)
        return pa.table({"shard": pa.array([shard], pa.int32()), "kind": pa.array([8], pa.int32()),
                         "n": pa.array([of.tolist() + [int(got[4].sum())]], pa.list_(pa.int64()))})

    return run


def discounts(of_counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney D1, D2, D3+ from n1..n4 (index = count); a count
    class that is empty leaves the plain estimate 0.5, 1, 1.5."""
    n1, n2, n3, n4 = (float(x) for x in of_counts[1:5])
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(j - (j + 1) * y * b / a, 1e-3), j - 1e-3)
                 for j, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


class KneserNey:
    """A trained model: the folder of arrays and a few numbers."""

    def __init__(self, folder: str, sizes: list[int], tokens: int, pair_counts: list[int],
                 left_counts: list[int], left_total: int):
        self.folder, self.sizes, self.tokens = folder, tuple(sizes), tokens
        self.d2, self.d1 = discounts(pair_counts), discounts(left_counts)
        self.left_counts, self.left_total = left_counts, left_total

    @property
    def words(self) -> int:
        return int(sum(self.sizes))


def train(docs: DataFrame) -> KneserNey:
    """Count a model from all texts of ``docs`` (column ``text``)."""
    spark = docs.sparkSession
    folder = qualified(spark, new_folder(spark, "kneser-ney"))
    texts = docs.select(text_or_empty().alias("text"))
    message = "shard int, data binary"
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(MIN_SHARD_BITS, (int(size) // SHARD_BYTES).bit_length())
    shards = 1 << bits
    counted = texts.mapInArrow(_word_counter(bits), message).groupBy("shard").applyInArrow(
        _store_words(folder), "shard int, n long, tokens long").collect()  # one row per shard
    sizes = [0] * shards
    for r in counted:
        sizes[r["shard"]] = r["n"]
    tokens = sum(r["tokens"] for r in counted)
    for s in set(range(shards)) - {r["shard"] for r in counted}:  # empty shards
        save_array(folder, f"words-{s:06d}", np.zeros(0, np.uint64))
        save_array(folder, f"counts-{s:06d}", np.zeros(0, np.int64))
    offsets = tuple(np.concatenate([[0], np.cumsum(sizes)]).tolist())
    if offsets[-1] + 2 >= 1 << _ORDER_BITS:
        raise ValueError("more than 2**32 - 2 distinct words: word numbers need more bits")
    pairs = texts.mapInArrow(_pair_counter(folder, tuple(sizes)), message).groupBy("shard").applyInArrow(
        _store_pairs(folder, offsets), "shard int, kind int, data binary")
    stats = pairs.groupBy("shard").applyInArrow(_store_stats(folder, offsets), "shard int, kind int, n array<long>")
    # One row per shard: counts of counts only.
    rows = stats.collect()
    pair_counts = np.sum([r["n"] for r in rows if r["kind"] == 9] or [[0] * 6], axis=0).tolist()
    left = np.sum([r["n"] for r in rows if r["kind"] == 8] or [[0] * 7], axis=0).tolist()
    model = KneserNey(folder, sizes, tokens, pair_counts, left[:6], left[6])
    # Shards that no bigram reached, and word shards without any count.
    for s in set(range(shards)) - {r["shard"] for r in rows if r["kind"] == 9}:
        save_array(folder, f"pairs-{s:06d}", np.zeros(0, np.uint64))
        save_array(folder, f"times-{s:06d}", np.zeros(0, np.uint32))
    for s in set(range(shards)) - {r["shard"] for r in rows if r["kind"] == 8}:
        save_array(folder, f"context-{s:06d}", np.zeros(4 * sizes[s], np.uint32))
        save_array(folder, f"left-{s:06d}", np.zeros(sizes[s], np.uint32))
    if not tokens:
        save_array(folder, f"context-{shards:06d}", np.zeros(4, np.uint32))
    return model


class _Scorer:
    """The mapped model in a worker."""

    def __init__(self, m: KneserNey):
        self.m = m
        self.n = n = len(m.sizes)
        self.vocabulary = _vocabulary(m.folder, m.sizes)
        self.pairs = [map_array(m.folder, f"pairs-{s:06d}", np.uint64) for s in range(n)]
        self.times = [map_array(m.folder, f"times-{s:06d}", np.uint32) for s in range(n)]
        self.counts = [map_array(m.folder, f"counts-{s:06d}", np.int64) for s in range(n)]
        self.left = [map_array(m.folder, f"left-{s:06d}", np.uint32) for s in range(n)]
        self.context = [map_array(m.folder, f"context-{s:06d}", np.uint32).reshape(4, -1) for s in range(n + 1)]

    def _of_words(self, numbers: np.ndarray) -> tuple:
        """(count, left, context[4]) of distinct sorted word numbers."""
        m, offset = self.m, self.vocabulary.offset
        count, left = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        context = np.zeros((4, len(numbers)), np.int64)
        for s in range(self.n):
            a, b = np.searchsorted(numbers, [offset[s] + 1, offset[s + 1] + 1])
            if a < b:
                at = numbers[a:b] - offset[s] - 1
                count[a:b], left[a:b], context[:, a:b] = self.counts[s][at], self.left[s][at], self.context[s][:, at]
        last = numbers == m.words + 1
        if last.any():
            context[:, last] = self.context[self.n][:, :1]
        return count, left, context

    def score(self, texts: pa.Array) -> tuple:
        """Per text: tokens, known tokens, base score, model score."""
        m = self.m
        hashes, first = sequences(texts)
        n_tokens = np.diff(first)
        number = self.vocabulary.number(hashes)
        words = np.unique(np.concatenate([number, [m.words + 1]]))
        count, left, context = self._of_words(words)
        # P1: continuation distribution over the vocabulary and one unknown.
        d = np.array([0.0, *m.d1])[np.minimum(left, 3)]
        total = max(m.left_total, 1)
        mass = sum(x * m.left_counts[k] for k, x in ((1, m.d1[0]), (2, m.d1[1]))) + m.d1[2] * sum(m.left_counts[3:])
        spare = mass / total if m.left_total else 1.0
        p1 = (left - d) / total + spare / (m.words + 1)
        # Contexts: total count and the mass left to P1.
        c = context[3]
        gamma = np.where(c > 0, (m.d2[0] * context[0] + m.d2[1] * context[1] + m.d2[2] * context[2]) / np.maximum(c, 1), 1.0)
        keys, index = np.unique(_pairs(number, first, m.words + 1), return_inverse=True)
        seen = np.zeros(len(keys), np.int64)
        shard = _pair_shard(keys, self.n.bit_length() - 1)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.n + 1))
        for s in range(self.n):
            mine = order[cuts[s] : cuts[s + 1]]
            have = self.pairs[s]
            if len(mine) and len(have):
                at = np.minimum(np.searchsorted(have, keys[mine]), len(have) - 1)
                seen[mine] = np.where(have[at] == keys[mine], self.times[s][at], 0)
        v = np.searchsorted(words, (keys >> np.uint64(_ORDER_BITS)).astype(np.int64))
        w = np.searchsorted(words, (keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
        d = np.array([0.0, *m.d2])[np.minimum(seen, 3)]
        p = np.where(c[v] > 0, (seen - d) / np.maximum(c[v], 1), 0.0) + gamma[v] * p1[w]
        log_p = np.log10(p)[index]
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        at = np.searchsorted(words, number)
        sums = [np.add.reduceat(x[at] if x is not log_p else x, first[:-1]) if len(first) > 1 else np.zeros(0)
                for x in ((count > 0).astype(np.int64), base, log_p)]
        return n_tokens, *sums


def scored(docs: DataFrame, model: KneserNey) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row."""
    def run(batches):
        scorer = _Scorer(model)
        for chunk in gathered(batches, CHUNK_BYTES // 2):
            n, known, base, score = scorer.score(chunk.column("text").combine_chunks())
            yield from pa.table({
                "doc_id": chunk.column("doc_id"), "n_tokens": pa.array(n.astype(np.int64)),
                "n_known": pa.array(known.astype(np.int64)), "base_score": pa.array(base.astype(float)),
                "score": pa.array(score.astype(float)),
            }).to_batches()

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under the model of the training rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = check_mod(F.col("doc_id"), 5) == 1
    model = train(docs.filter(~held))
    return scored(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
