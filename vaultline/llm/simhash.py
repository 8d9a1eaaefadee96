"""SimHash fingerprints and exact search within a Hamming radius.

A text's terms are its shingles of ``SHINGLE`` consecutive words.  Each term
occurrence votes with its weight (its characters: longer terms are rarer) on
128 signed bits: +w where its hash has a 1, -w where it has a 0.  The sign of
each total is the fingerprint's bit.

The votes are plain long sums.  ``(h >> i) & 0x100000001`` puts bit i and bit
i+32 of a hash into the two halves of one long, so 64 sums count 128 bits; a
half overflows only beyond 4e9 characters of terms in one text.  A text's
terms are exploded and summed within one map task, so the shuffle carries one
row per text.

``near_counts`` searches some fingerprints against all of them: the bits are cut
into ``radius + 1`` blocks with a table for each, and by the pigeonhole principle
a pair at most ``radius`` bits apart agrees on at least one block.  Equal
fingerprints are one entry, so groups of copies do not multiply.  The entries of a
block value are dealt into chunks of about ``CHUNK``, and a fingerprint meets
one row per chunk: the distance filter and the sums run inside that row, so
what leaves the join is one row per fingerprint and chunk, not per pair.  A
pair that agrees on several blocks counts in the first of them.

Edge cases: NULL text is empty; an empty text is the single term ''; texts of
fewer words than a shingle are one term; repeated rows each keep their row;
rows with a NULL id stand outside the document order (their next document is
themselves); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.llm.common import table, text_or_empty, written

SHINGLE = 3
BITS = 128
RADIUS = 3  # bits between near fingerprints
EVERY = 20  # ids divisible by this are searched
CHUNK = 512  # entries of a block value that meet a fingerprint in one row
BUCKET = 10  # 2**10 consecutive ids are ordered in one window partition
WIDE = 20  # 2**20 buckets, and blocks of them, at most in another one
_MASK = 0x100000001


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per ``keys`` value with ``fingerprint`` (32 hex digits) and
    ``n_rows`` (input rows of that key; equal keys must have equal texts).

    Keys should be fixed-width so that the vote sums stay in a hash aggregate.
    """
    words = texts.select(*keys, F.split(F.col(text), r"\s+", -1).alias("_w"))
    terms = words.select(*keys, "_w", F.posexplode("_w").alias("_pos", "_one"))
    terms = terms.filter((F.col("_pos") == 0) | (F.col("_pos") <= F.size("_w") - SHINGLE))
    parts = [F.get(F.col("_w"), F.col("_pos") + i) for i in range(SHINGLE)]
    weight = sum((F.coalesce(F.length(p), F.lit(0)) for p in parts), F.lit(1)).cast("long")
    votes = terms.select(
        *keys, (F.col("_pos") == 0).cast("long").alias("_first"), weight.alias("_weight"),
        F.xxhash64(*parts).alias("_h0"), F.xxhash64(F.lit(7), *parts).alias("_h1"),
    )
    sums = [
        F.sum(F.shiftrightunsigned(F.col(f"_h{h}"), i).bitwiseAND(F.lit(_MASK)) * F.col("_weight")).alias(f"_s{h}_{i}")
        for h in (0, 1) for i in range(32)
    ]
    total = votes.groupBy(*keys).agg(F.sum("_first").alias("n_rows"), F.sum("_weight").alias("_total"), *sums)

    def half(h: int) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            s = F.col(f"_s{h}_{i}")
            for bit, votes_for in ((i, s.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(s, 32))):
                out = out.bitwiseOR(F.shiftleft((votes_for * 2 > F.col("_total")).cast("long"), bit))
        return F.lpad(F.hex(out), 16, "0")

    return total.select(*keys, "n_rows", F.lower(F.concat(half(0), half(1))).alias("fingerprint"))


def _half(fp: Column, i: int) -> Column:
    """16 hex digits as a signed long."""
    return F.conv(F.substring(fp, 1 + 16 * i, 16), 16, -10).cast("long")


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two hex fingerprints."""
    out = F.lit(0)
    for i in range(0, BITS // 4, 8):
        x = F.conv(F.substring(a, 1 + i, 8), 16, 10).cast("long")
        y = F.conv(F.substring(b, 1 + i, 8), 16, 10).cast("long")
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def near_counts(docs: DataFrame, radius: int = RADIUS, every: int = EVERY) -> DataFrame:
    """(fingerprint, n_equal, low_id, high_id, n_other, other) of the
    fingerprints of ``docs`` (id, fingerprint) with an id divisible by
    ``every``: the documents with that fingerprint and their outer ids, the
    documents with another one at most ``radius`` bits apart, and (distance,
    id) of the nearest of them, the smallest id first."""
    one = docs.select("id", "fingerprint").distinct().groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low_id"), F.max("id").alias("high_id"),
        F.max(F.col("id") % every == 0).alias("wanted"))
    one = written(one.select("*", _half(F.col("fingerprint"), 0).alias("hi"), _half(F.col("fingerprint"), 1).alias("lo")),
                  "simhash-prints")
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    masks = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        whole = (1 << BITS - a) - (1 << BITS - b)
        masks.append([F.lit(x - (x >> 63 << 64)).cast("long") for x in (whole >> 64, whole & (1 << 64) - 1)])
    blocks = F.array(*[F.struct(F.col("hi").bitwiseAND(h).alias("h"), F.col("lo").bitwiseAND(w).alias("w")) for h, w in masks])
    entries = one.select("hi", "lo", "n", "low_id", "wanted", F.posexplode(blocks).alias("t", "b")).select(
        "hi", "lo", "n", "low_id", "wanted", "t", "b.h", "b.w")
    # Block values that a wanted fingerprint shares with another: few of all.
    key = ["t", "h", "w"]
    shared = written(entries.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.max("wanted").alias("any")).filter(
        "any AND size > 1").select(*key, F.ceil(F.col("size") / F.lit(CHUNK)).cast("int").alias("chunks")), "simhash-blocks")
    met = entries.join(shared, key)
    chunks = met.groupBy(*key, F.pmod(F.xxhash64("hi", "lo"), F.col("chunks")).cast("int").alias("chunk")).agg(
        F.collect_list(F.struct("hi", "lo", "n", "low_id")).alias("those"))
    asked = met.filter("wanted").select("hi", "lo", *key, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def apart(x: Column) -> Column:
        return F.bit_count(F.col("q_hi").bitwiseXOR(x["hi"])) + F.bit_count(F.col("q_lo").bitwiseXOR(x["lo"]))

    def first(x: Column) -> Column:
        """No table before this one has the pair."""
        high, low = F.col("q_hi").bitwiseXOR(x["hi"]), F.col("q_lo").bitwiseXOR(x["lo"])
        out = F.lit(True)
        for j, (h, w) in enumerate(masks[:-1]):
            out = out & ((F.col("t") <= j) | (high.bitwiseAND(h).bitwiseOR(low.bitwiseAND(w)) != 0))
        return out

    pairs = asked.withColumnsRenamed({"hi": "q_hi", "lo": "q_lo"}).join(chunks, [*key, "chunk"])
    near = pairs.select("q_hi", "q_lo", F.filter("those", lambda x: apart(x).between(1, radius) & first(x)).alias("near"))
    found = near.filter(F.size("near") > 0).select(
        "q_hi", "q_lo", F.aggregate("near", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n"),
        F.array_min(F.transform("near", lambda x: F.struct(apart(x).alias("distance"), x["low_id"].alias("id")))).alias("other"))
    found = found.groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg(
        F.sum("n").alias("n_other"), F.min("other").alias("other"))
    return one.filter("wanted").join(found, ["hi", "lo"], "left").select(
        "fingerprint", F.col("n").alias("n_equal"), "low_id", "high_id", F.coalesce("n_other", F.lit(0)).alias("n_other"), "other")


def _borders(ids: DataFrame) -> DataFrame:
    """(border_id, into): the first document of each id bucket, and the bucket
    that it follows in descending order (the lowest bucket is followed by the
    highest).  Three levels of windows: buckets within blocks of 2**WIDE bucket
    numbers, blocks within regions of 2**WIDE block numbers, and the regions, of
    which 64-bit ids have at most 2**14, however they are spread."""
    tops = ids.groupBy("bucket").agg(F.max("doc_id").alias("border_id")).withColumn("block", F.shiftright("bucket", WIDE))
    inner = tops.withColumn("into", F.lag("bucket").over(Window.partitionBy("block").orderBy(F.desc("bucket"))))
    blocks = tops.groupBy("block").agg(F.min("bucket").alias("low")).withColumn("region", F.shiftright("block", WIDE))
    above = F.lag("low").over(Window.partitionBy("region").orderBy(F.desc("block")))
    regions = blocks.groupBy("region").agg(F.min("low").alias("low")).withColumn("_one", F.lit(1))
    w = Window.partitionBy("_one").orderBy(F.desc("region"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    regions = regions.select("region", F.coalesce(F.lag("low").over(w), F.last("low").over(whole)).alias("beyond"))
    blocks = blocks.withColumn("above", above).join(regions, "region").select("block", F.coalesce("above", "beyond").alias("above"))
    return inner.join(blocks, "block").select("border_id", F.coalesce("into", "above").alias("into"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_id, next_text): the next document in descending id
    order; after the last comes the first.

    Texts are ordered within buckets of consecutive ids, and each bucket's
    last document meets a copy of the next bucket's first one, so one shuffle
    of the texts is enough and no task holds more than a bucket.
    """
    base = docs.select("doc_id", text_or_empty().alias("text"))
    known = base.filter("doc_id IS NOT NULL").withColumn("bucket", F.shiftright("doc_id", BUCKET))
    # Written first: its real size then decides whether it is broadcast.
    borders = written(_borders(known.select("doc_id", "bucket")), "simhash-borders")
    marked = known.join(borders, F.col("doc_id") == F.col("border_id"), "left")
    placed = marked.select(
        "doc_id", "text",
        F.explode(F.when(F.col("into").isNull(), F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copy"))))
                  .otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copy")),
                                     F.struct(F.col("into").alias("bucket"), F.lit(1).alias("copy"))))).alias("at"),
    ).select("doc_id", "text", "at.bucket", "at.copy")
    w = Window.partitionBy("bucket").orderBy("copy", F.desc("doc_id"), F.desc("text"))
    led = placed.select(
        "doc_id", "text", "copy", F.lead("doc_id").over(w).alias("next_id"), F.lead("text").over(w).alias("next_text"))
    alone = base.filter("doc_id IS NULL").select(
        "doc_id", "text", F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    return led.filter("copy = 0").drop("copy").unionByName(alone)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    Ids divisible by ``EVERY`` are searched against all documents: ``n_near``
    other documents at most ``RADIUS`` bits apart (rows without an id do not
    count), ``nearest_id`` the smallest id among the nearest of them (for the
    smallest id of equal fingerprints the largest); NULL for other ids.
    """
    docs = with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    edited = docs.select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.col("doc_id").isNotNull().alias("has"),
        F.xxhash64("text").alias("x"),
        F.coalesce("next_id", F.lit(0).cast("long")).alias("nid"), F.col("next_id").isNotNull().alias("nhas"),
        F.xxhash64("next_text").alias("nx"),
        n.cast("long").alias("n_chars"), "text",
        F.expr("concat(substring(text, 1, length(text) - length(text) DIV 3), substring(next_text, 1, CAST(length(text) DIV 3 AS int)))").alias("edited"),
    ).withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    keys = ["id", "has", "x", "nid", "nhas", "nx", "n_chars", "sha", "which"]
    both = edited.select(
        *keys[:-1], F.posexplode(F.array("text", "edited")).alias("which", "text"))
    prints = written(fingerprints(both, keys), "simhash")
    own = keys[:-1]
    rows = prints.groupBy(*own).agg(
        F.max("n_rows").alias("n_rows"),
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    following = prints.filter("which = 0").select(
        F.col("id").alias("nid"), F.col("has").alias("nhas"), F.col("x").alias("nx"),
        F.col("fingerprint").alias("next_fingerprint")).distinct()
    out = rows.join(following, ["nid", "nhas", "nx"])
    near = written(near_counts(prints.filter((F.col("which") == 0) & F.col("has"))), "simhash-near")
    # Rows that ask nothing get a key of their own: as NULL they would be one hot key.
    asked = F.when(F.col("has") & (F.col("id") % EVERY == 0), F.col("fingerprint")).otherwise(
        F.concat(F.lit("-"), F.hex("id")))
    out = out.withColumn("_asked", asked).join(near.withColumnRenamed("fingerprint", "_asked"), "_asked", "left")
    out = out.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    fp = F.col("fingerprint")
    return out.select(
        F.when(F.col("has"), F.col("id")).alias("doc_id"), "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(fp, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(fp, F.col("next_fingerprint")).alias("near_next"),
        (F.col("n_equal") - 1 + F.col("n_other")).alias("n_near"),
        F.when(F.col("n_equal") == 1, F.col("other.id")).when(F.col("low_id") == F.col("id"), F.col("high_id"))
        .otherwise(F.col("low_id")).alias("nearest_id"),
    )
