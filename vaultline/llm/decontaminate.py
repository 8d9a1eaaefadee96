"""Benchmark decontamination with an FM-index per training shard.

A benchmark item gives one phrase per window of ``WINDOW`` consecutive words
(the whole item if it is shorter).  The documents are split into shards of
about ``SHARD_BYTES`` of text, and each shard

1. becomes a word-id text over the benchmark's vocabulary.  A phrase can only
   occur inside a run of benchmark words that is as long as the shortest
   phrase, so other stretches are replaced by separators first; this loses no
   occurrence and keeps the index small;
2. is indexed: suffix order (prefix doubling), Burrows-Wheeler transform, a
   wavelet matrix over it for rank queries, and the positions of
   every ``SAMPLE``-th suffix;
3. is searched: all phrases step backwards together, two ranks per word; the
   occurrences found are located by walking to the next sampled position;
4. yields the spans covered, merged per document.

The phrases are broadcast in blocks of at most ``BLOCK_WORDS`` words in
expectation, one block at a time: a larger benchmark takes a pass over the
documents per block, whose spans are written and united with those of the next
pass.  Driver and workers hold one block (the driver the next one besides).

Words are runs of ASCII letters and digits and all non-ASCII characters,
A-Z lower-cased.  Word identity is a 64-bit hash.

Edge cases: NULL or empty texts have no words; an item without words has no
phrase; repeated rows and NULL ids keep their rows (each is searched as its
own document); repeated item ids are one item with the phrases of all its rows; an empty
benchmark or an empty table finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import ALNUM, Tokens, gathered, small_batches, table, tokenize, written

WINDOW = 10
SHARD_BYTES = 2 << 20
SAMPLE = 8
BLOCK_WORDS = 1_000_000


# --- phrases ---------------------------------------------------------------


@dataclass
class Phrases:
    """Distinct phrases as word ids (0-based in ``words``), grouped by length."""

    words: np.ndarray  # sorted uint64 word hashes of the vocabulary
    groups: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]
    # per length: (phrases, length) ids; per phrase the owning items
    items: list[str]

    @property
    def shortest(self) -> int:
        return min((g[0].shape[1] for g in self.groups), default=0)


def phrases(item_ids: list, texts: list[str | None], window: int = WINDOW) -> Phrases:
    t = tokenize(pa.array(texts, pa.string()), ALNUM)
    words = np.unique(t.hash)
    ids = np.searchsorted(words, t.hash).astype(np.int64)
    names = sorted({str(i) for i in item_ids})
    number = {n: k for k, n in enumerate(names)}
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for k, (a, b) in enumerate(zip(t.first[:-1], t.first[1:], strict=True)):
        if a == b:
            continue
        size = min(window, b - a)
        w = np.lib.stride_tricks.sliding_window_view(ids[a:b], size)
        by_length.setdefault(size, []).append((w, number[str(item_ids[k])]))
    groups = []
    for size in sorted(by_length):
        rows = np.concatenate([w for w, _ in by_length[size]])
        owner = np.concatenate([np.full(len(w), i) for w, i in by_length[size]])
        distinct, index = np.unique(rows, axis=0, return_inverse=True)
        order = np.lexsort((owner, index.ravel()))
        index, owner = index.ravel()[order], owner[order]
        cut = np.flatnonzero(np.diff(index)) + 1
        groups.append((distinct, np.arange(len(distinct)), [np.unique(o) for o in np.split(owner, cut)]))
    return Phrases(words, groups, names)


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW) -> Iterator[Phrases]:
    """The benchmark's phrases in blocks of bounded size."""
    words = benchmark.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = int(words // BLOCK_WORDS) + 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for b in range(blocks):
        rows = benchmark.filter((part == b) & F.col("text").isNotNull()).select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").collect()
        if rows:
            found = phrases([r["item_id"] for r in rows], [r["text"] for r in rows], window)
            if found.groups:
                yield found


# --- FM-index --------------------------------------------------------------


class WaveletMatrix:
    """Ranks over a symbol array, one bit level per array; vectorised."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[np.ndarray] = []  # per level: zeros before each position
        self.bits = max(1, int(top).bit_length())
        s = symbols
        for bit in range(self.bits - 1, -1, -1):
            zero = ((s >> bit) & 1) == 0
            self.levels.append(np.concatenate([[0], np.cumsum(zero, dtype=np.int32)]).astype(np.int32))
            s = np.concatenate([s[zero], s[~zero]])
        self.size = len(symbols)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol[i]`` stands before position ``at[i]``."""
        low = np.zeros_like(at)
        high = at.copy()
        for level, zeros in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - level)) & 1) == 1
            total = zeros[-1]
            low = np.where(one, total + low - zeros[low], zeros[low])
            high = np.where(one, total + high - zeros[high], zeros[high])
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at each position, its rank before that position)."""
        symbol = np.zeros(len(at), np.int64)
        low, here = np.zeros_like(at), at.copy()
        for zeros in self.levels:
            one = zeros[here + 1] == zeros[here]
            total = zeros[-1]
            symbol = symbol * 2 + one
            low = np.where(one, total + low - zeros[low], zeros[low])
            here = np.where(one, total + here - zeros[here], zeros[here])
        return symbol, here - low


class FMIndex:
    """Backward search over a text of symbols ``1..top`` (0 separates).

    Separators sort by position, so no two suffixes are equal and a walk back
    through the text never leaves its run: the first word of every run is
    sampled as well.
    """

    def __init__(self, text: np.ndarray, top: int, sample: int = SAMPLE):
        text = np.concatenate([text, [0]]).astype(np.int64)
        n = len(text)
        gap = text == 0
        rank = np.where(gap, np.cumsum(gap) - 1, int(gap.sum()) + text)
        step = 1
        while True:  # prefix doubling until all suffixes differ
            distinct, rank = np.unique(rank, return_inverse=True)
            if len(distinct) == n:
                break
            after = np.zeros(n, np.int64)  # beyond the end: the smallest key
            after[: n - step] = rank[step:] + 1
            rank = rank * (n + 1) + after
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.bwt = text[order - 1]
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.wavelet = WaveletMatrix(self.bwt, top)
        starts = np.r_[True, gap[:-1]]
        sampled = (order % sample == 0) | starts[order]
        self.sampled = sampled
        self.before = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]
        self.size = n

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [low, high) of each row of ``patterns``."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, j].astype(np.int64)
            low = self.counts[c] + self.wavelet.rank(c, low)
            high = self.counts[c] + self.wavelet.rank(c, high)
            high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks, walking back to a sampled one."""
        out = np.full(len(rows), -1, np.int64)
        at, steps, left = rows.astype(np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(left):
            done = self.sampled[at]
            out[left[done]] = self.positions[self.before[at[done]]] + steps[done]
            at, steps, left = at[~done], steps[~done] + 1, left[~done]
            symbol, rank = self.wavelet.access(at)
            at = self.counts[symbol] + rank
        return out


def _reduced(ids: np.ndarray, first: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word numbers): the runs of benchmark words of at least
    ``shortest`` words, a 0 after each; runs end at document borders."""
    n = len(ids)
    known = ids > 0
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[first] = True
    starts = known.copy()
    starts[1:] &= ~known[:-1] | fresh[1:n]
    start = np.flatnonzero(starts)
    stop_at = np.flatnonzero(~known | fresh[:n])  # a run ends before the next of these
    pos = np.searchsorted(stop_at, start, side="right")
    end = np.where(pos < len(stop_at), np.append(stop_at, n)[pos], n)
    keep = end - start >= shortest
    start, size = start[keep], (end - start)[keep]
    total = int((size + 1).sum())
    symbols = np.zeros(total, np.int64)
    words = np.full(total, -1, np.int64)
    offset = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(start, size) + within
    target = np.repeat(offset, size) + within
    symbols[target] = ids[source]
    words[target] = source
    return symbols, words


def search_shard(t: Tokens, block: Phrases) -> tuple:
    """(hit words, (document, item) pairs) of one shard."""
    hit = np.zeros(len(t) + 1, np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    if len(t):
        at = np.minimum(np.searchsorted(block.words, t.hash), len(block.words) - 1)
        ids = np.where(block.words[at] == t.hash, at + 1, 0)
        symbols, words = _reduced(ids, t.first, block.shortest)
        index = FMIndex(symbols, len(block.words)) if len(symbols) else None
        for patterns, _, owners in block.groups if index else []:
            low, high = index.search(patterns + 1)
            found = high - low
            which = np.repeat(np.arange(len(patterns)), found)
            if not len(which):
                continue
            rows = np.repeat(low, found) + np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
            where = words[index.locate(rows)]
            np.add.at(hit, where, 1)
            np.add.at(hit, where + patterns.shape[1], -1)
            doc = np.searchsorted(t.first, where, side="right") - 1
            # Distinct (document, phrase) first: a phrase may have many items.
            both = np.unique(np.column_stack([doc, which]), axis=0)
            sizes = np.array([len(owners[w]) for w in both[:, 1]])
            item = np.concatenate([owners[w] for w in both[:, 1]])
            pairs.append((np.repeat(both[:, 0], sizes), item))
    return np.cumsum(hit[:-1]) > 0, pairs


def _lists(doc: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    sizes = np.bincount(doc, minlength=n)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


SCHEMA = "n_words long, n_hit long, items array<string>, starts array<int>, ends array<int>"


def _held(t: Tokens, shard: pa.Table) -> np.ndarray:
    """Words inside the spans that earlier blocks have found."""
    starts, ends = (shard.column(c).combine_chunks() for c in ("starts", "ends"))
    doc = np.repeat(np.arange(shard.num_rows), starts.value_lengths().to_numpy(zero_copy_only=False))
    base = t.offsets[:-1][doc]
    first = np.searchsorted(t.start, base + starts.flatten().to_numpy(zero_copy_only=False), side="left")
    last = np.searchsorted(t.end, base + ends.flatten().to_numpy(zero_copy_only=False), side="right")
    hit = np.zeros(len(t) + 1, np.int64)
    np.add.at(hit, first, 1)
    np.add.at(hit, last, -1)
    return np.cumsum(hit[:-1]) > 0


def _without(texts: pa.Array, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts without the byte spans (sorted by document and place)."""
    out = texts.to_pylist()
    cut = np.searchsorted(doc, np.unique(doc), side="left").tolist() + [len(doc)]
    for a, b in zip(cut, cut[1:]):
        raw, at, kept = out[doc[a]].encode(), 0, []
        for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist()):
            kept.append(raw[at:s])
            at = e
        kept.append(raw[at:])
        out[doc[a]] = b"".join(kept).decode()
    return pa.array(out, pa.string())


def _searcher(block, shard_bytes: int, columns: list[str], more: bool, cut: bool):
    """mapInArrow function: input columns pass through, result columns follow.

    ``starts``/``ends`` are byte ranges of the whole UTF-8 text.  ``more``: the
    input has the result columns of earlier blocks, which are added to.  ``cut``:
    the spans are taken out of ``text`` instead, without result columns."""

    def run(batches):
        for shard in gathered(batches, shard_bytes):
            texts = shard.column("text").combine_chunks()
            t = tokenize(texts, ALNUM)
            phrases = block.value if block is not None else None
            covered, pairs = search_shard(t, phrases) if phrases else (np.zeros(len(t), dtype=bool), [])
            n = shard.num_rows
            doc = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in pairs]])
            item = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in pairs]])
            found = np.array(phrases.items if phrases else [], dtype=object)[item].astype(str)
            if more:
                covered |= _held(t, shard)
                known = shard.column("items").combine_chunks()
                doc = np.concatenate([doc, np.repeat(np.arange(n), known.value_lengths().to_numpy(zero_copy_only=False))])
                found = np.concatenate([found, np.array(known.flatten().to_pylist(), dtype=str)])
            # Merged spans: maximal runs of covered words of one document.
            doc_of = t.doc
            border = np.zeros(len(t), dtype=bool)
            border[1:] = doc_of[1:] != doc_of[:-1]
            before = np.zeros(len(t), dtype=bool)
            before[1:] = covered[:-1]
            first = np.flatnonzero(covered & (~before | border))
            after = np.zeros(len(t), dtype=bool)
            after[:-1] = covered[1:] & ~border[1:]
            last = np.flatnonzero(covered & ~after)
            spans_doc = doc_of[first]
            base = t.offsets[:-1][spans_doc]
            starts, ends = (t.start[first] - base).astype(np.int32), (t.end[last] - base).astype(np.int32)
            out = [shard.column(c).combine_chunks() for c in columns]
            if cut:
                out[columns.index("text")] = _without(texts, spans_doc, starts, ends)
                yield from pa.table(out, names=columns).to_batches(max_chunksize=2000)
                continue
            total = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
            # Items are ordered as strings by their bytes.
            order = np.lexsort((found, doc))
            doc, found = doc[order], found[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
            out += [
                pa.array(np.diff(t.first).astype(np.int64)), pa.array(total[t.first[1:]] - total[t.first[:-1]]),
                _lists(doc[new], found[new], n, pa.string()),
                _lists(spans_doc, starts, n, pa.int32()), _lists(spans_doc, ends, n, pa.int32()),
            ]
            yield from pa.table(out, names=[*columns, "n_words", "n_hit", "items", "starts", "ends"]).to_batches(
                max_chunksize=2000)

    return run


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
           columns: list[str] | None = None, cut: bool = False) -> DataFrame:
    """``columns`` of ``docs`` with n_words, n_hit, items (found item ids,
    sorted), and the merged hit spans as byte offsets ``starts``/``ends``; with
    ``cut`` only the columns, the spans taken out of ``text``.

    ``docs`` must have a ``text`` column; the result columns must not be among
    ``columns``.
    """
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    small_batches(spark)
    columns = docs.columns if columns is None else columns
    carried = list(dict.fromkeys([*columns, "text"]))
    rows = docs.select(*carried)
    given = rows.schema
    results = StructType.fromDDL(SCHEMA).fields
    last, more = None, False
    for block in phrase_blocks(benchmark, window):
        if last is not None:  # another block follows: its pass starts from this one's spans
            rows = written(rows.mapInArrow(_searcher(last, shard_bytes, carried, more, False),
                                           StructType(given.fields + results)), "decontaminate")
            last.destroy()
            more = True
        last = spark.sparkContext.broadcast(block)
    schema = StructType([given[c] for c in columns] + ([] if cut else results))
    return rows.mapInArrow(_searcher(last, shard_bytes, list(columns), more, cut), schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every word that lies in a phrase occurrence removed from
    ``text``; other rows and columns stay as they are."""
    # Input columns get neutral names meanwhile, so any name may clash.
    names = docs.columns
    inner = docs.select(*[docs[c].alias("text" if c == "text" else f"c{i}") for i, c in enumerate(names)])
    clean = search(inner, benchmark, window, cut=True)
    return clean.select(*[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(names)])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

