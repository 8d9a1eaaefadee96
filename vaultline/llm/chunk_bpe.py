"""BPE encoding and decoding with content-defined chunks that are encoded once.

A rolling hash over the last ``WINDOW`` bytes of the normalised text cuts it
into chunks (a cut before each byte whose window hashes to zero), so equal
passages fall into equal chunks wherever they stand.  Between its first and
its last white space a chunk encodes alike in every context; this part is its
core, and what is shared between documents.

1. Core hashes are counted over all documents; hashes seen twice set a bit in a
   sieve of ``SIEVE_BITS`` bits (fixed size).  A false hit only ships a core
   that nobody shares.
2. Documents are read again.  Texts without a shared core are encoded and
   decoded at once.  The others become segments: references to shared cores and
   the text between them (the joins and all chunks of their own), encoded here.
   Each join is checked by re-encoding the words on both sides of it together
   and apart; where they disagree the core is given up and the join grows over
   it, until both agree.
3. Each distinct core is encoded once, wherever in the cluster it is used.
4. References meet their cores and each document's segments are put together
   in order, hashed and decoded.

References to a core that holds more than one in ``SPREAD`` of all references
are salted, and the core is copied once per salt; the list of those cores has at
most ``SPREAD`` rows and is the only table that is broadcast.

The method holds for tokenizers of the ``tokenizers`` library whose pieces
never contain ASCII white space (the pre-tokenizer drops it); others are
refused.  The tokenizer is never changed: special tokens are cut out of the raw
text as the library does, and the rest is normalised by the library (texts below
U+0300, all composed, by lower-casing, to the same pieces).

Edge cases: NULL and empty texts have no tokens; rows with NULL or repeated ids
are documents of their own; texts without white space are encoded whole;
an empty table gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import _BASE, _BASE_INV, _powers, mix64, new_folder, pieces, small_batches, table, text_bytes

WINDOW = 16
CUT_BITS = 9  # a cut every 512 bytes or so
MIN_CORE = 64  # bytes below which a core isn't worth a reference
SIEVE_BITS = 24
SPREAD = 1024
PIECE = 1 << 20  # bytes of text handled at once
WORDS = 1 << 19  # words whose ids a worker keeps (about 130 MB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = re.compile(r"[^ \t-\r]+")
_WORD_BEFORE, _WORD_AFTER = re.compile(r"[^ \t-\r]*\Z"), re.compile(r"[ \t-\r]*[^ \t-\r]*")

#: Below U+0300 this normaliser only lower-cases and joins white space, which
#: the pre-tokenizer drops.
_LOWERS = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_DEALT = ("kind string, part int, row long, seq int, doc_id long, n_tokens long, ids_sha256 string, "
          "decoded_sha256 string, key binary, ids binary, core string")


class Coder:
    """The library's tokenizer, taken apart: special tokens, normaliser and the
    rest, so that a passage can be encoded on its own."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parts = json.loads(spec)
        whole = Tokenizer.from_str(spec)
        added = parts["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("only plain special tokens are supported")
        self.special = {t["content"]: t["id"] for t in added}
        any_special = "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.pattern = re.compile(f"({any_special})") if added else None
        self.normalizer = whole.normalizer
        self.lowers = parts["normalizer"] == _LOWERS
        whole.no_truncation()
        whole.no_padding()
        self.whole = whole
        inner = Tokenizer.from_str(json.dumps({**parts, "added_tokens": [], "normalizer": None, "post_processor": None,
                                               "truncation": None, "padding": None}))
        self.inner = inner
        if [p for p, _ in inner.pre_tokenizer.pre_tokenize_str("a b\tc\n. d")] != ["a", "b", "c", ".", "d"]:
            raise ValueError("the tokenizer's pieces may hold white space")
        self.dtype = np.dtype("<u2") if whole.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.words: dict[str, bytes] = {}

    def segments(self, text: str):
        """(text, None) of ordinary passages and (None, id) of special tokens."""
        if self.pattern is None or not self.pattern.search(text):
            return [(text, None)]
        return [(None, self.special[p]) if p in self.special else (p, None) for p in self.pattern.split(text) if p]

    def normal(self, text: str, high: bool) -> str:
        if self.normalizer is None:
            return text
        return text.lower() if self.lowers and not high else self.normalizer.normalize_str(text)

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of normalised passages.  Pieces end at white space, so a
        passage's ids are those of its words; a worker encodes a word once
        while it keeps it."""
        texts = [_WORD.findall(t) for t in texts]
        new = {w for t in texts for w in t if w not in self.words}
        if len(self.words) + len(new) > WORDS:
            self.words.clear()
            new = {w for t in texts for w in t}
        new = list(new)
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            for w, e in zip(some, self.inner.encode_batch_fast(some, add_special_tokens=False)):
                self.words[w] = self.packed(e.ids)
        get = self.words.__getitem__
        return [b"".join(map(get, t)) for t in texts]

    def digest(self, packed: bytes) -> tuple[int, str, str]:
        """(number, hash of the ids, hash of the decoded text)."""
        ids = np.frombuffer(packed, dtype=self.dtype)
        decoded = self.whole.decode(ids.tolist(), skip_special_tokens=False)
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8")).hexdigest())


_CODERS: dict[str, Coder] = {}


def coder(spec: str) -> Coder:
    """One coder per worker process."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(spec)
    return _CODERS[key]


class Chunks:
    """Chunk cores of a batch of normalised texts: core ``i`` covers bytes
    ``start[i]:end[i]`` of ``data`` and lies in text ``text[i]``."""

    def __init__(self, texts: list[str]):
        data, offs = text_bytes(pa.array(texts, pa.large_string()))
        n = len(data)
        self.data, self.offs = data, offs
        up, down = _powers(_BASE, max(n + 1, PIECE)), _powers(_BASE_INV, max(n + 1, PIECE))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        cuts = np.zeros(0, np.int64)
        if n > WINDOW:
            rolled = (sums[WINDOW:n] - sums[: n - WINDOW]) * down[: n - WINDOW]
            cuts = np.flatnonzero(rolled < np.uint64(1 << 64 - CUT_BITS)) + WINDOW
            # The window lies in one text, and no character is cut.
            cuts = cuts[(cuts - WINDOW >= offs[np.searchsorted(offs, cuts, side="right") - 1])
                        & (data[cuts] & 0xC0 != 0x80)]
        edges = np.union1d(cuts, offs)
        spaces = np.flatnonzero(_SPACE[data])
        first = np.searchsorted(spaces, edges[:-1])
        last = np.searchsorted(spaces, edges[1:]) - 1
        some = last > first
        start, end = spaces[first[some]], spaces[last[some]]
        long = end - start >= MIN_CORE
        self.start, self.end = start[long], end[long]
        self.text = np.searchsorted(offs, self.start, side="right") - 1
        self.hash = mix64((sums[self.end] - sums[self.start]) * down[self.start]).astype(np.int64)


def _batches(batches, spec: str):
    """(coder, doc ids, per document list of (passage or None, special id))
    with the passages normalised."""
    c = coder(spec)
    for b in batches:
        texts = b.column("text")
        for at, to in pieces(texts, PIECE):
            part = texts.slice(at, to - at)
            data, offs = text_bytes(part)
            leads = np.flatnonzero(data >= 0xCC)  # lead bytes of U+0300 and above
            high = np.searchsorted(leads, offs[1:]) > np.searchsorted(leads, offs[:-1])
            docs = []
            for text, h in zip(part.to_pylist(), high):
                docs.append([(None if t is None else c.normal(t, h), s) for t, s in c.segments(text or "")])
            yield c, b.column("doc_id").slice(at, to - at).to_pylist(), docs


def _counted(spec: str):
    def run(batches):
        for _, _, docs in _batches(batches, spec):
            chunks = Chunks([t for d in docs for t, _ in d if t is not None])
            key, n = np.unique(chunks.hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["hash", "n"])

    return run


def sieve(docs: DataFrame, spec: str) -> np.ndarray:
    """Bits of the core hashes that occur more than once (SIEVE_BITS bits)."""
    place = F.shiftrightunsigned("hash", 64 - SIEVE_BITS)
    words = (
        docs.mapInArrow(_counted(spec), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
        .filter("n > 1").select(F.shiftright(place, 6).cast("int").alias("word"),
                                F.expr("shiftleft(1L, CAST(shiftrightunsigned(hash, %d) & 63 AS INT))" % (64 - SIEVE_BITS)).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**SIEVE_BITS / 64 rows
    )
    out = np.zeros(1 << SIEVE_BITS - 6, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def _hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.astype(np.uint64) >> np.uint64(64 - SIEVE_BITS)
    return (bits.astype(np.uint64)[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _agreeing(c: Coder, chunks: Chunks, at: np.ndarray) -> np.ndarray:
    """Which of the cores ``at`` join their surroundings: the words on both
    sides of either edge encode together as they do apart."""
    pairs, which = [], []
    for i in at:
        lo, hi = chunks.offs[chunks.text[i]], chunks.offs[chunks.text[i] + 1]
        s, e = chunks.start[i], chunks.end[i]
        for edge in (s, e):
            left = bytes(chunks.data[max(lo, edge - 256) : edge]).decode("utf-8", "ignore")
            right = bytes(chunks.data[edge : min(hi, edge + 256)]).decode("utf-8", "ignore")
            pairs.append((_WORD_BEFORE.search(left)[0], _WORD_AFTER.match(right)[0]))
            which.append(i)
    known = {w: None for p in pairs for w in (p[0], p[1], p[0] + p[1])}
    known = dict(zip(known, c.encode(list(known))))
    bad = [i for (a, b), i in zip(pairs, which) if known[a] + known[b] != known[a + b]]
    return at[~np.isin(at, bad)]


def _dealt(spec: str, bits):
    def run(batches):
        part = TaskContext.get().partitionId()
        row = 0
        sent: set[bytes] = set()
        for c, ids, docs in _batches(batches, spec):
            texts = [t for d in docs for t, _ in d if t is not None]
            chunks = Chunks(texts)
            shared = _agreeing(c, chunks, np.flatnonzero(_hit(bits.value, chunks.hash)))
            cores: dict[int, list[int]] = {}
            for i in shared:
                cores.setdefault(int(chunks.text[i]), []).append(int(i))
            # Per document: passages to encode and references, in order.
            plan, passages, k = [], [], 0
            for d in docs:
                steps = []
                for t, special in d:
                    if t is None:
                        steps.append(("ids", c.packed([special])))
                        continue
                    if k in cores:
                        at = int(chunks.offs[k])
                        for i in [*cores[k], None]:
                            to = int(chunks.offs[k + 1]) if i is None else int(chunks.start[i])
                            if to > at:
                                steps.append(("text", len(passages)))
                                passages.append(bytes(chunks.data[at:to]).decode("utf-8"))
                            if i is not None:
                                at = int(chunks.end[i])
                                steps.append(("core", bytes(chunks.data[int(chunks.start[i]) : at])))
                    elif t:
                        steps.append(("text", len(passages)))
                        passages.append(t)
                    k += 1
                plan.append(steps)
            encoded = c.encode(passages)
            out = []
            for doc_id, steps in zip(ids, plan):
                row += 1
                parts = [(kind, encoded[v] if kind == "text" else v) for kind, v in steps]
                if all(kind != "core" for kind, _ in parts):
                    n, a, b = c.digest(b"".join(v for _, v in parts))
                    out.append({"kind": "whole", "part": part, "row": row, "doc_id": doc_id, "n_tokens": n,
                                "ids_sha256": a, "decoded_sha256": b})
                    continue
                for seq, (kind, v) in enumerate(parts):
                    line = {"part": part, "row": row, "seq": seq, "doc_id": doc_id}
                    if kind == "core":
                        key = hashlib.blake2b(v, digest_size=16).digest()
                        out.append({**line, "kind": "reference", "key": key})
                        if key not in sent:
                            if len(sent) >= 1 << 16:  # a task may send a core again, it is still encoded once
                                sent.clear()
                            sent.add(key)
                            out.append({"kind": "core", "key": key, "core": v.decode("utf-8")})
                    else:
                        out.append({**line, "kind": "segment", "ids": v})
            yield pa.RecordBatch.from_pylist(out, schema=_DEALT_ARROW)

    return run


_DEALT_ARROW = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("row", pa.int64()), ("seq", pa.int32()), ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("key", pa.binary()),
    ("ids", pa.binary()), ("core", pa.string())])


def _encoded(spec: str):
    def run(batches):
        c = coder(spec)
        for b in batches:
            cores = b.column("core")
            for at, to in pieces(cores, PIECE):
                ids = c.encode(cores.slice(at, to - at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").slice(at, to - at),
                     pa.array(ids, pa.binary())], names=["key", "ids"])

    return run


def _assembled(spec: str):
    def run(batches):
        c = coder(spec)
        for b in batches:
            out = [(d, *c.digest(b"".join(s["ids"] for s in segments)))
                   for d, segments in zip(b.column("doc_id").to_pylist(), b.column("segments").to_pylist())]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Number of tokens and hashes of the ids and of the decoded text of every
    row of ``docs`` (doc_id, text); ``tokenizer`` is a file of the
    ``tokenizers`` library, read on the driver only."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    coder(spec)  # refuses tokenizers that the method doesn't hold for
    sent = spark.sparkContext.broadcast(spec)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def over(make, *args):
        return lambda batches: make(sent.value, *args)(batches)

    bits = spark.sparkContext.broadcast(sieve(docs, spec))
    folder = new_folder(spark, "chunk-bpe")
    docs.mapInArrow(over(_dealt, bits), _DEALT).write.partitionBy("kind").option("compression", "zstd").parquet(folder)

    schema = spark.createDataFrame([], _DEALT).schema
    dealt = spark.read.schema(schema).parquet(folder)
    cores = dealt.filter("kind = 'core'").select("key", "core").distinct().mapInArrow(
        over(_encoded), "key binary, ids binary")
    references = dealt.filter("kind = 'reference'").select("part", "row", "seq", "doc_id", "key")
    uses = references.groupBy("key").agg(F.count(F.lit(1)).alias("uses"))
    total = references.count()
    # Cores with more than total/SPREAD uses: fewer than SPREAD rows.
    hot = F.broadcast(uses.filter(F.col("uses") * SPREAD > total).select(
        "key", F.ceil(F.col("uses") * SPREAD / F.lit(max(total, 1))).cast("int").alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    spread = references.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("part", "row", "seq"), copies).cast("int"))
    copied = cores.join(hot, "key", "left").select(
        "key", "ids", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    met = spread.join(copied, ["key", "salt"]).select("part", "row", "seq", "doc_id", "ids")
    segments = met.unionByName(dealt.filter("kind = 'segment'").select("part", "row", "seq", "doc_id", "ids"))
    put_together = segments.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("segments"),
    ).select("doc_id", "segments").mapInArrow(over(_assembled), RESULT)
    whole = dealt.filter("kind = 'whole'").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    return whole.unionByName(put_together)


def op12_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of the whole ``documents`` table."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
