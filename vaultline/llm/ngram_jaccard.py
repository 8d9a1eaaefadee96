"""N-gram Jaccard join with Bayesian candidate pruning (BayesLSH).

Finds the documents whose sets of ``SHINGLE``-word shingles have a Jaccard
similarity of at least ``THRESHOLD``.

1. Texts with the same shingle set are one class, represented by the smallest
   id; everything below works on representatives only.
2. Each representative has ``HASHES`` MinHash values, cut into bands of
   ``ROWS``.  Pairs that agree on a band are candidates; at the threshold a
   pair is missed with probability (1 - 0.8**4)**32 < 5e-8.  The minimum is
   taken over 32 bits and its low 16 are kept: equal minima stay equal, and a
   chance match (2**-16) can only keep a pair for the exact check.
3. Buckets of one band are cut into tiles of bounded size, so a bucket of any
   size is spread over tasks.  Inside a tile all pairs are compared on their
   MinHash values, 16 at a time; a pair is dropped as soon as the posterior
   probability of reaching the threshold falls below ``TOLERANCE``.  A pair
   that meets in several bands counts only in the first one.
4. The tiles with survivors get the texts of the members that survive (a bit
   table of fixed size sifts the others out before texts are shuffled), and
   every surviving pair is verified on the exact sets.  A tile returns one row per
   member: its number of links there and the smallest member it is
   connected to, not the pairs.
5. Groups are the connected components of all links.

Pairs within a group of n near copies are compared inside tiles and never
emitted; what is shuffled grows with members times tiles.

Words are runs of non-white-space, A-Z lower-cased.  A text of fewer than
five words is one shingle of all its words.

Edge cases: NULL, empty and blank texts have no shingles and are linked to
nothing; rows with a NULL id are left out of the join (and kept by
``keep_one``); repeated rows of an id with one text count once; an id with
several texts has a row per text, each of which is a document of its own to
``keep_one``; an empty table gives an empty result; documents of any length are used
whole.  Ids must be whole numbers (others are an error).  Columns of the input
other than id and text are carried by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import SPACED, mix64, pieces, small_batches, table, text_or_empty, tokenize, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
TOLERANCE = 1e-8  # loses a pair at exactly 0.8 with probability 9e-8; 1e-4 would lose 8e-4
STEP = 16
TILE = 512  # members per side of a tile
SPREAD = 1024
SIEVE_WORDS = 1 << 18  # longs of the bit table over surviving ids (bounds its broadcast)

_SEEDS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingle hashes of each text."""
    t = tokenize(texts, SPACED)
    n = len(t.first) - 1
    size = np.diff(t.first)
    count = np.where(size == 0, 0, np.maximum(size - SHINGLE + 1, 1))
    doc = np.repeat(np.arange(n), count)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = t.first[:-1][doc] + within
    last = t.first[1:][doc] - 1
    h = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        inside = at + k <= last
        word = t.hash[np.minimum(at + k, last)] if len(at) else np.zeros(0, np.uint64)
        h = np.where(inside, mix64(h * np.uint64(0x100000001B3) + word), h)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
    h, doc = h[new], doc[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int64)


def minhashes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, HASHES) uint16 MinHash values; texts without shingles get 0."""
    n = len(offsets) - 1
    out = np.zeros((n, HASHES), np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    starts = offsets[:-1][full]
    for k in range(HASHES):
        # The high half of a product with an odd number, xor-ed with another.
        v = ((hashes ^ _SEEDS[HASHES - 1 - k]) * _SEEDS[k]) >> np.uint64(32)
        out[full, k] = np.minimum.reduceat(v, starts).astype(np.uint16)
    return out


def _sign(batches):
    """Per text: a digest of its shingle set and its MinHash signature."""
    for b in (b.slice(at, to - at) for b in batches for at, to in pieces(b.column(b.schema.get_field_index("text")))):
        h, offs = shingle_sets(b.column(b.schema.get_field_index("text")))
        sig = minhashes(h, offs)
        size = np.diff(offs)
        # Set digest: two sums of mixed members (order does not matter).
        zero = np.zeros(1, np.uint64)
        sums = [np.concatenate([zero, np.cumsum(mix64(h ^ np.uint64(s)))]) for s in (1, 2)]
        digest = [(c[offs[1:]] - c[offs[:-1]]).view(np.int64) for c in sums]
        keep = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays([
            b.column(b.schema.get_field_index("doc_id")).take(pa.array(keep)),
            pa.array(digest[0][keep]), pa.array(digest[1][keep]), pa.array(size[keep].astype(np.int64)),
            pa.array([sig[i].tobytes() for i in keep], pa.binary()),
        ], names=["doc_id", "d0", "d1", "n", "sig"])


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """Per number of compared values (a multiple of STEP): the least number of
    matches at which P(similarity >= threshold | matches) reaches the
    tolerance, under a uniform prior (Beta posterior, integrated numerically)."""
    grid = (np.arange(20000) + 0.5) / 20000
    out = []
    for seen in range(STEP, HASHES + 1, STEP):
        for m in range(seen + 1):
            log = m * np.log(grid) + (seen - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                out.append(m)
                break
    return tuple(out)


def surviving_pairs(sig: np.ndarray, band: int, rows: np.ndarray, cols: np.ndarray, same: bool) -> tuple:
    """(i, j) among ``rows`` x ``cols`` (indexes into ``sig``) whose posterior
    stays up and that share no band before ``band``."""
    i, j = np.meshgrid(rows, cols, indexing="ij")
    if same:
        use = np.triu(np.ones(i.shape, dtype=bool), 1)
        i, j = i[use], j[use]
    else:
        i, j = i.ravel(), j.ravel()
    matches = np.zeros(len(i), np.int32)
    for block, least in enumerate(least_matches()):
        if not len(i):
            break
        part = slice(block * STEP, (block + 1) * STEP)
        equal = sig[i, part] == sig[j, part]
        # Bands of this step that lie before the bucket's band.
        first = equal.reshape(len(i), STEP // ROWS, ROWS).all(2)
        earlier = np.arange(block * STEP // ROWS, (block + 1) * STEP // ROWS) < band
        matches += equal.sum(1, dtype=np.int32)
        keep = (matches >= least) & ~first[:, earlier].any(1)
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def _tile_pairs(members: pa.Table):
    """Sides of the tile's square: indexes of its rows and columns."""
    band = members.column("band")[0].as_py()
    sig = np.frombuffer(b"".join(members.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
    side = members.column("side").to_numpy()
    same = members.column("same")[0].as_py()
    rows = np.flatnonzero(side == 0)
    cols = rows if same else np.flatnonzero(side == 1)
    # The same order in both passes over a tile.
    ids = members.column("rep").to_numpy()
    rows, cols = rows[np.argsort(ids[rows], kind="stable")], cols[np.argsort(ids[cols], kind="stable")]
    return ids, sig, band, rows, cols, same


def _chunks(rows, cols, same):
    """Blocks of a tile's pairs: bounded memory even if a tile is uneven."""
    for a in range(0, len(rows), 256):
        if same:
            yield rows[a : a + 256], rows[a : a + 256], True
            rest = rows[a + 256 :]
        else:
            rest = cols
        for b in range(0, len(rest), 256):
            yield rows[a : a + 256], rest[b : b + 256], False


def _members(members: pa.Table) -> pa.Table:
    """Members of the tile that have a surviving pair."""
    ids, sig, band, rows, cols, same = _tile_pairs(members)
    alive = np.zeros(len(ids), dtype=bool)
    for r, c, s in _chunks(rows, cols, same):
        i, j = surviving_pairs(sig, band, r, c, s)
        alive[i] = alive[j] = True
    return members.filter(pa.array(alive)).select(["tile", "band", "same", "side", "rep", "sig"])


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of 0..n-1 (label propagation)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(members: pa.Table) -> pa.Table:
    """Exact Jaccard of the surviving pairs; links and root per member."""
    ids, sig, band, rows, cols, same = _tile_pairs(members)
    h, offs = shingle_sets(members.column("text").combine_chunks())
    size = np.diff(offs)
    owner = np.repeat(np.arange(len(ids)), size)
    # Only shingles held by two members or more can be in an intersection.
    order = np.argsort(h, kind="stable")
    hs, os_ = h[order], owner[order]
    new = np.r_[True, hs[1:] != hs[:-1]] if len(hs) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    times = np.bincount(number) if len(number) else np.zeros(0, int)
    shared = times[number] > 1
    hs, os_ = number[shared], os_[shared]
    if len(hs):
        hs = np.unique(hs, return_inverse=True)[1]
    # Shared shingles of each member, sorted.
    by = np.lexsort((hs, os_))
    hs, os_ = hs[by], os_[by]
    cut = np.concatenate([[0], np.cumsum(np.bincount(os_, minlength=len(ids)))])
    top = int(hs.max()) + 1 if len(hs) else 0
    links_i, links_j = [], []
    for r, c, s in _chunks(rows, cols, same):
        i, j = surviving_pairs(sig, band, r, c, s)
        if not len(i):
            continue
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        held = np.zeros(top + 1, np.int8)
        common = np.zeros(len(i), np.int64)
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(i)], strict=True):
            mine = hs[cut[i[a]] : cut[i[a] + 1]]
            held[mine] = 1
            partners = j[a:b]
            lengths = cut[partners + 1] - cut[partners]
            # The partners' shared shingles in bounded pieces.
            at = 0
            while at < len(partners):
                to = max(at + 1, at + int(np.searchsorted(np.cumsum(lengths[at:]), 1 << 20, side="right")))
                flat = np.concatenate([hs[cut[p] : cut[p + 1]] for p in partners[at:to]] or [np.zeros(0, np.int64)])
                got = np.concatenate([[0], np.cumsum(held[flat], dtype=np.int64)])
                ends = np.cumsum(lengths[at:to])
                common[a + at : a + to] = got[ends] - got[ends - lengths[at:to]]
                at = to
            held[mine] = 0
        # common / union >= threshold in whole numbers (threshold = 8 / 10).
        linked = common * 10 >= (size[i] + size[j] - common) * round(THRESHOLD * 10)
        links_i.append(i[linked])
        links_j.append(j[linked])
    i = np.concatenate(links_i or [np.zeros(0, np.int64)]).astype(np.int64)
    j = np.concatenate(links_j or [np.zeros(0, np.int64)]).astype(np.int64)
    by_id = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    root = _roots(len(ids), place[i], place[j])
    degree = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    some = np.flatnonzero(degree)
    return pa.table({"rep": pa.array(ids[some]), "n_links": pa.array(degree[some].astype(np.int64)),
                     "root": pa.array(ids[by_id[root[place[some]]]])})


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, d0, d1, n, sig) of every document with shingles."""
    small_batches(docs.sparkSession)
    rows = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_sign, "doc_id long, d0 long, d1 long, n long, sig binary")


def _tiles(reps: DataFrame) -> DataFrame:
    """(tile, band, same, side, rep, sig): the buckets of at least two
    representatives, cut into tiles of about TILE members a side."""
    width = ROWS * 2
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))).alias("key")),
    )
    banded = reps.select("rep", F.inline(keys))
    # Bucket sizes need only the keys (partially aggregated); single ones go.
    sizes = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    member = banded.join(sizes, ["band", "key"])
    parts = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    mine = F.pmod(F.xxhash64("rep", F.lit(11)), parts).cast("int")
    member = member.withColumn("parts", parts).withColumn("mine", mine)
    # A tile (a, b), a <= b, gets part a as rows and part b as columns.
    squares = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(
            F.xxhash64("band", "key", F.least(F.col("mine"), other), F.greatest(F.col("mine"), other)).alias("tile"),
            (F.col("mine") == other).alias("same"),
            F.when(F.col("mine") <= other, 0).otherwise(1).alias("side"),
        ),
    )
    return member.select("band", "rep", F.inline(squares))


_TILE = "tile long, band int, same boolean, side int, rep long, sig binary"


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): smallest node connected to each node of (a, b) edges.

    Every round replaces each node's neighbours by links to the smallest
    neighbour and written tables cut the lineage; a star is done at once and a
    chain halves, so rounds grow with the logarithm of a component's width.
    """
    spark = edges.sparkSession
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    current = written(both, name)
    while True:
        # Large star: link all larger neighbours to the smallest one.
        sym = current.select("v", "u").unionAll(current.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = sym.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = sym.join(low, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = written(large.filter("v <> u").distinct(), name)
        # Small star: link a node and its smaller neighbours to the smallest.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        near = large.join(low, "v")
        small = near.filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionAll(
            low.select("v", F.col("m").alias("u")))
        small = written(small.filter("v <> u").distinct(), name)
        if not _differ(small, current):
            break
        current = small
    stars = current.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())


def _differ(a: DataFrame, b: DataFrame) -> bool:
    """Whether two edge tables differ (order-free sums, one row each)."""
    def summed(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(summed(a)) != tuple(summed(b))


def sifted(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted`` (one
    long column of the same name): a superset of the exact semi join.

    Ids set bits in a table of ``SIEVE_WORDS`` longs, whatever their number, so
    it is broadcast; the fuller it gets, the fewer rows it sifts out.
    """
    slot = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(SIEVE_WORDS * 64))
    placed = {"_word": F.shiftright(slot, 6), "_bit": F.pmod(slot, F.lit(64)).cast("int")}
    bits = wanted.withColumns(placed).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    met = rows.withColumns(placed).join(F.broadcast(bits), "_word")
    return met.filter("shiftrightunsigned(_bits, _bit) & 1L = 1").select(*rows.columns)


def _items(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` (doc_id, text, ...) with ``item``, a number of its own for every id and
    text: the id, or, where one id has several texts, a hashed number above all
    ids.  Also whether there are such ids."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    plain = docs.withColumn("item", F.col("doc_id"))
    text = F.xxhash64(text_or_empty())
    many = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).filter(
        "a <> b").select(F.col("doc_id").alias("many"))
    if not many.limit(1).count():
        return plain, False
    many = written(many, "jaccard-repeated")
    marked = docs.join(many, F.col("doc_id") == F.col("many"), "left")
    # Above every id, so that a group's smallest number is an id where it has one.
    top = docs.agg(F.max("doc_id")).first()[0]
    if top >= 2**62:
        raise ArithmeticError("no numbers are left above the ids for repeated ones")
    for salt in range(64):
        number = F.lit(top + 1) + F.pmod(F.xxhash64("doc_id", text, F.lit(salt)), F.lit(2**62 - 1 - max(top, 0)))
        met = marked.filter("many IS NOT NULL").select("doc_id", text.alias("t"), number.alias("n")).distinct()
        if not met.groupBy("n").count().filter("count > 1").limit(1).count():
            return marked.withColumn("item", F.when(F.col("many").isNull(), F.col("doc_id")).otherwise(number)).drop("many"), True
    raise ArithmeticError("no free numbers for repeated ids")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, copy_of) of every document with an id.

    ``class_id``: smallest id of the group (connected links and equal sets);
    ``n_links``: other distinct texts at similarity >= THRESHOLD to this one;
    ``copy_of``: smallest id with the same shingle set.
    """
    items, repeated = _items(docs.select("doc_id", "text"))
    found = _near(items.select(F.col("item").alias("doc_id"), "text"))
    if not repeated:
        return found
    ids = items.filter("doc_id IS NOT NULL").select("item", "doc_id").distinct()
    named = found.withColumnRenamed("doc_id", "item").join(ids, "item")
    low = {c: named.groupBy(c).agg(F.min("doc_id").alias(f"of_{c}")) for c in ("class_id", "copy_of")}
    return named.join(low["class_id"], "class_id").join(low["copy_of"], "copy_of").select(
        "doc_id", F.col("of_class_id").alias("class_id"), "n_links", F.col("of_copy_of").alias("copy_of"))


def _near(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` of rows whose id tells their text."""
    signed = written(signatures(docs), "jaccard-signatures")
    # Copies: one representative per shingle set, found by an aggregate.
    classes = written(signed.groupBy("d0", "d1", "n").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "jaccard-classes")
    own = signed.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
    own = own.groupBy(F.col("doc_id").alias("rep")).agg(F.min_by("sig", "d0").alias("sig"))
    own = written(own, "jaccard-representatives")
    tiles = _tiles(own).join(own, "rep").select("tile", "band", "same", "side", "rep", "sig")
    alive = written(tiles.groupBy("tile").applyInArrow(_members, _TILE), "jaccard-survivors")
    # The texts of surviving members only; one text per representative.
    wanted = alive.select(F.col("rep").alias("want")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("want"), text_or_empty().alias("text"))
    # An inner join (wanted ids are distinct): a semi join would be pushed below the sieve.
    texts = sifted(texts, "want", wanted).join(wanted, "want").groupBy("want").agg(F.first("text").alias("text"))
    full = alive.join(texts, F.col("rep") == F.col("want")).select(
        "tile", "band", "same", "side", "rep", "sig", "text")
    links = written(full.groupBy("tile").applyInArrow(_verify, "rep long, n_links long, root long"), "jaccard-links")
    degree = links.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    group = connected(links.select(F.col("rep").alias("a"), F.col("root").alias("b")), "jaccard-groups")
    # Joined per class first, then once to the members.
    found = written(classes.join(degree, "rep", "left").join(group, F.col("rep") == F.col("node"), "left").select(
        "d0", "d1", "n", "size", F.coalesce("root", "rep").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("rep").alias("copy_of")), "jaccard-found")
    named = _members_of(signed.select("doc_id", "d0", "d1", "n").distinct(), found)
    ids = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct()
    return ids.join(named, F.col("id") == F.col("doc_id"), "left").select(
        F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("copy_of", "id").alias("copy_of"))


def _members_of(members: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, copy_of) of the members of each shingle set.
    Sets that hold more than one in SPREAD documents (fewer than SPREAD sets) meet
    their members by broadcast, the others by a join of parts of even size."""
    key, values = ["d0", "d1", "n"], ["class_id", "n_links", "copy_of"]
    total = found.agg(F.sum("size")).first()[0] or 0
    large = F.broadcast(found.filter(F.col("size") * SPREAD > total).select(*key, F.struct(*values).alias("of")))
    marked = members.join(large, key, "left")
    rest = found.filter(F.col("size") * SPREAD <= total).select(*key, *values)
    return marked.filter("of IS NOT NULL").select("doc_id", "of.*").unionByName(
        marked.filter("of IS NULL").drop("of").join(rest, key).select("doc_id", *values))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    items, _ = _items(packed)
    extra = _near(items.select(F.col("item").alias("doc_id"), "text")).filter("doc_id <> class_id").select(
        F.col("doc_id").alias("extra"))
    kept = items.select("item", "row").join(extra, F.col("item") == F.col("extra"), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, links and copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
