"""Toxicity, quality, SimHash, mixing, n-gram Jaccard join."""
import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_fixtures import docs, small  # noqa: F401
from vaultline.llm import mixing as M
from vaultline.llm import ngram_jaccard as J
from vaultline.llm import quality as Q
from vaultline.llm import simhash as Z
from vaultline.llm import toxicity as T

RNG = np.random.default_rng(5)
WORDS = [f"w{k}" for k in range(400)]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


# --- toxicity ---

def test_toxic_documents_are_found(spark, docs):
    rows, labels = [], []
    for i in range(400):
        words = prose(80).split()
        if i % 5 == 0:
            for w in RNG.choice(["scum", "vile", "foul"], 1 + i % 9):
                words.insert(int(RNG.integers(len(words))), w + ",")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(1000, "a very VILE foul text scum"), (1001, prose(20000)), (1002, None), (1003, ""), (None, "scum scum scum"), (1000, "vile foul scum")]
    d = docs(rows).withColumn("_severity", F.lit("kept"))
    marks = spark.createDataFrame([*labels, (5, 1), (None, 1), (7, None), (99999, 1)], "doc_id long, toxic int")
    out = T.rated(d, marks).collect()
    assert len(out) == len(rows)
    level = {r.doc_id: r.severity for r in out}
    assert min(level[i] for i in range(0, 400, 5)) > T.REJECT > max(level[i] for i in range(400) if i % 5)
    assert level[1000] > 1 > T.REJECT > max(level[1001], level[1002], level[1003]) and level[None] > T.REJECT
    assert level[1002] == level[1003]
    kept = T.keep_clean(d, marks)
    assert kept.columns == d.columns and {r._severity for r in kept.collect()} == {"kept"}
    assert {r.severity for r in T.rated(d, marks.filter("toxic = 0")).collect()} == {0.0}
    assert T.keep_clean(d.limit(0), marks).collect() == []


# --- quality ---

def test_quality_on_held_out_rows(spark, small):
    rows = {r.doc_id: r for r in Q.op7_quality(spark, small).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{small}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[r.doc_id].predicted == r.quality for r in labels]) > 0.9


def test_statistics_of_odd_texts(spark, docs):
    import pyarrow as pa
    x = Q.statistics(pa.array([None, "", " ", "a", "!" * 100, "word " * 30000, "É é"]))
    assert np.isfinite(x).all() and x.shape == (7, len(Q.STATISTICS))
    assert (x[0] == x[1]).all()
    d = docs([(1, "a"), (2, None)]).select("doc_id", Q.stats_column(F.col("text")).alias("x"))
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.scored(d, Q.fit(Q.training(d, empty))).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (9, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in Q.scored(d, Q.fit(Q.training(d, one))).collect())


# --- SimHash ---

def edited(rows):
    """Brute force of the edited text, for distinct ids."""
    order = sorted(rows, reverse=True)
    out = {}
    for k, i in enumerate(order):
        t, nxt = rows[i] or "", rows[order[(k + 1) % len(order)]] or ""
        n = len(t) // 3
        out[i] = t[: len(t) - n] + nxt[:n]
    return out


def test_edits_and_likeness(spark, tmp_path):
    rows = {i: prose(60) for i in [0, 3, 1023, 1024, 1025, 5000, 5001, 9_000_000, -7, 40]}
    rows |= {41: None, 42: "", 43: "é", 44: rows[3], 45: "ab cd"}
    spark.createDataFrame([*rows.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in Z.op8_simhash(spark, str(tmp_path)).collect()}
    want = edited(rows)
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.n_chars == len(rows[i] or "") and r.edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[3].fingerprint == got[44].fingerprint and got[41].fingerprint == got[42].fingerprint
    assert min(got[i].near_edited for i in (0, 1023, 5001)) > 0.6


def test_likeness_separates(spark, small):
    rows = Z.op8_simhash(spark, small).collect()
    near, far = np.array([r.near_edited for r in rows]), np.array([r.near_next for r in rows])
    assert np.median(near) > 0.7 and np.median(far) < 0.6


def test_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "x y z x y z"), (2, "q")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Z.op8_simhash(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert Z.op8_simhash(spark, f"{tmp_path}/e").collect() == []


def test_next_document_of_ids_spread_over_64_bits(spark, monkeypatch):
    """Hashed ids: every bucket holds one, and they are ordered by many tasks."""
    ids = sorted({int(i) for i in RNG.integers(-(2**63), 2**63 - 1, 3000)} | {-(2**63), 2**63 - 1, 0, 1, 2, 1024}, reverse=True)
    d = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    got = {r.doc_id: (r.next_id, r.next_text) for r in Z.with_next(d).collect()}
    assert got == {i: (n, str(n)) for i, n in zip(ids, [*ids[1:], ids[0]])}
    for wide in (1, 4):  # levels of a few members each
        monkeypatch.setattr(Z, "WIDE", wide)
        small = d.filter("doc_id BETWEEN -4000000000000000000 AND 4000000000000000000")
        kept = [i for i in ids if abs(i) <= 4 * 10**18]
        got = {r.doc_id: r.next_id for r in Z.with_next(small).collect()}
        assert got == dict(zip(kept, [*kept[1:], kept[0]]))


def test_the_smallest_id_is_an_id(spark, tmp_path):
    rows = [(-(2**63), "a b c"), (None, "d e f"), (0, "g h i"), (20, "a b c")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in Z.op8_simhash(spark, str(tmp_path)).collect()}
    assert set(got) == {-(2**63), None, 0, 20} and got[20].n_near == 1 and got[0].n_near == 0
    assert got[20].near_next < 1 and got[None].near_next == 1


@pytest.mark.parametrize("radius, chunk", [(0, 512), (3, 4), (3, 512), (5, 7)])
def test_near_counts_match_brute_force(spark, monkeypatch, radius, chunk):
    monkeypatch.setattr(Z, "CHUNK", chunk)
    rows = []
    for k in range(240):
        x = 1 << 127 | k % 7 << 40 if k < 200 else int.from_bytes(RNG.bytes(16), "big")
        for bit in RNG.choice(128, int(RNG.integers(0, 4)), replace=False):
            x ^= 1 << int(bit)
        rows.append((k - 20, f"{x:032x}"))
    rows += [(500, rows[0][1]), (500, rows[0][1]), (501, rows[7][1])]
    got = {r.fingerprint: r for r in Z.near_counts(spark.createDataFrame(rows, "id long, fingerprint string"), radius, 5).collect()}
    assert set(got) == {p for i, p in rows if i % 5 == 0}
    for p, r in got.items():
        apart = {(i, o): (int(p, 16) ^ int(o, 16)).bit_count() for i, o in rows}
        same = [i for (i, _), d in apart.items() if d == 0]
        other = [(d, i) for (i, _), d in apart.items() if 0 < d <= radius]
        assert (r.n_equal, r.low_id, r.high_id, r.n_other) == (len(same), min(same), max(same), len(other))
        assert (r.other and tuple(r.other)) == (min(other) if other else None)


def test_corpus_is_searched(spark, tmp_path):
    text = prose(300)
    rows = [(0, text), (1, text), (20, "other words only"), (40, text), (60, prose(50)), (7, text), (None, text)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_near, r.nearest_id) for r in Z.op8_simhash(spark, str(tmp_path)).collect()}
    assert got == {0: (3, 40), 40: (3, 0), 20: (0, None), 60: (0, None), 1: (None, None), 7: (None, None), None: (None, None)}


# --- mixing ---

def test_mixing_reaches_target_shares(spark):
    rows = [(i, "a" if i % 10 else "b", f"t{i}") for i in range(4000)] + [(None, None, None), (5, "a", "t5")]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copy", F.lit("clash"))
    out = M.replicate(d, weights={"a": 1.0, "b": 2.0}, size=2.0).collect()
    n = {s: sum(r.source == s for r in out) for s in ("a", "b")}
    assert n["b"] / n["a"] == pytest.approx(2.0, rel=0.12)
    per = {}
    for r in out:
        per.setdefault((r.doc_id, r.text), []).append(r)
    assert all({x.copy for x in v} == set(range(1, v[0].n_copies + 1)) for v in per.values())
    assert len(per[5, "t5"]) == 2 * per[5, "t5"][0].n_copies if (5, "t5") in per else True
    assert M.replicate(d.limit(0)).collect() == []


def test_counts_follow_the_distribution(spark):
    from math import exp, factorial
    d = spark.range(20000).selectExpr("id AS doc_id", "'s' AS source", "'' AS text")
    got = [r["n"] for r in M.replicate(d, size=1.7).groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    for k in range(1, 6):
        assert got.count(k) / 20000 == pytest.approx(exp(-1.7) * 1.7**k / factorial(k), abs=0.012)


def test_distribution_of_any_rate(spark):
    """Cumulative probabilities against exact sums, from tiny to very large rates."""
    from math import exp, lgamma, log
    wanted = [0.01, 0.7, 5.0, 31.5, 400.0, 1e6]
    rated = spark.createDataFrame([(None if i == 0 else f"s{i}", r) for i, r in enumerate(wanted)], "mix_source string, mix_rate double")
    got = {r.mix_rate: r for r in M.distributions(rated).collect()}
    for rate in wanted:
        row = got[rate]
        assert len(row.mix_cums) < 24 * rate**0.5 + 80 and all(a <= b < 1 for a, b in zip(row.mix_cums, row.mix_cums[1:]))
        exact, at = 0.0, []
        for k in range(row.mix_least, row.mix_least + len(row.mix_cums)):
            exact += exp(-rate + k * log(rate) - lgamma(k + 1))
            at.append(exact)
        assert max(abs(a - b) for a, b in zip(row.mix_cums, at)) < (1e-13 if rate < 1e5 else 1e-7)  # lgamma loses digits there
    mean = sum(1 - c for c in got[1e6].mix_cums) + got[1e6].mix_least
    assert abs(mean - 1e6) < 1e-3


def test_a_rare_source_repeated_many_times(spark):
    """Copies of one row are dealt out in blocks, whole and in order."""
    rows = [(i, "big", "b") for i in range(60000)] + [(10**6, "rare", "r"), (10**6 + 1, "rare", "q")]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for n in ("mix_rate", "mix_cums", "block", "row", "k", "rate"):
        d = d.withColumn(n, F.lit(n))
    out = M.replicate(d)
    assert set(out.columns) == {*d.columns, *M.ADDED}
    rare = out.filter("source = 'rare'").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.countDistinct("copy").alias("k"), F.max("copy").alias("top"), F.max("n_copies").alias("c"), F.max("mix_rate").alias("m")).collect()
    assert len(rare) == 2 and all(r.n == r.k == r.top == r.c and abs(r.n - 15000.5) < 1000 and r.m == "mix_rate" for r in rare)
    big = out.filter("source = 'rare'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert big > 1
    keys = [(r.p, r.shuffle_key) for r in out.select(F.spark_partition_id().alias("p"), "shuffle_key").collect()]
    assert keys == sorted(keys) and [k for _, k in keys] == sorted(k for _, k in keys)


def test_texts_are_shuffled_once(spark):
    d = spark.createDataFrame([(1, "a", "t"), (2, "b", "u")], "doc_id long, source string, text string")
    plan = M.replicate(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") - plan.count("ReusedExchange") == 1 and "rangepartitioning" not in plan


# --- n-gram Jaccard join ---

def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_groups(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        if i is not None:
            sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    reps = {}
    for i in sorted(sets):
        reps.setdefault(sets[i] or i, i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(sets, 0)
    for a, b in combinations(sorted(reps.values()), 2):
        k = len(sets[a] & sets[b])
        if k and k * 10 >= 8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    for i in sets:
        x, y = sorted((find(i), find(reps[sets[i] or i])))
        root[y] = x
    return {i: (find(i), links[reps[sets[i] or i]], reps[sets[i] or i]) for i in sets}


def near_rows():
    rows, i = [], 0
    for _ in range(6):
        base = prose(200).split()
        for _ in range(25):
            w = list(base)
            for at in RNG.choice(len(w), int(RNG.integers(0, 9)), replace=False):
                w[at] = "edit"
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(900 + k, prose(50)) for k in range(40)]
    rows += [(1000, rows[0][1]), (1001, "  " + rows[0][1].upper()), (1002, "one two"), (1003, "One two"), (1004, None), (1005, ""),
             (1006, " \n"), (1007, prose(30000)), (None, rows[0][1])]
    return rows


def test_groups_match_brute_force(docs, monkeypatch):
    rows = near_rows()
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_of) for r in J.near_duplicates(docs(rows)).collect()}
    assert got == brute_groups(rows)
    kept = sorted(-1 if r.doc_id is None else r.doc_id for r in J.keep_one(docs(rows)).collect())
    assert kept == sorted([-1, *{c for c, _, _ in got.values()}])


def test_texts_that_share_an_id_and_any_column_names(docs):
    """A text goes only if it is itself a copy, whatever its id's other texts are."""
    a, b, c = prose(60), prose(60), prose(60)
    rows = [(3, a), (7, a), (7, b), (8, c), (8, c + " and more of it"), (9, b + " with an end"), (10, c), (10, c), (None, a), (11, None), (11, "")]
    d = docs(rows)
    for n in ["_extra", "extra", "item", "row", "many", "class_id", "want", "n"]:
        d = d.withColumn(n, F.lit(n))
    out = J.keep_one(d)
    assert out.columns == d.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    texts = [t for _, t in kept]
    assert (3, a) in kept and (7, a) not in kept and (None, a) in kept and kept.count((11, None)) == kept.count((11, "")) == 1
    near = lambda *ts: sum(texts.count(t) for t in ts)
    assert near(b, b + " with an end") == 1 and near(c, c + " and more of it") in (1, 2)  # one id's equal rows may stay together
    found = {(r.doc_id, r.class_id) for r in J.near_duplicates(d).collect()}
    assert {(3, 3), (7, 3), (7, 7), (9, 7), (8, 8), (10, 8)} <= found
    assert {r._extra for r in out.collect()} == {"_extra"}


def test_tiles_lose_no_pair(docs, monkeypatch):
    monkeypatch.setattr(J, "TILE", 4)
    rows = near_rows()[:80]
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_of) for r in J.near_duplicates(docs(rows)).collect()}
    assert got == brute_groups(rows)


def test_sieve_keeps_every_wanted_row(spark, monkeypatch):
    rows = spark.range(20000).selectExpr("IF(id = 7, NULL, id - 300) AS want", "'x' AS text")
    wanted = spark.range(0, 20000, 50).selectExpr("id - 300 AS want")
    exact = {x - 300 for x in range(0, 20000, 50)}
    got = [r.want for r in J.sifted(rows, "want", wanted).collect()]
    assert exact <= set(got) and len(got) == len(set(got)) < 20000 * 0.05
    monkeypatch.setattr(J, "SIEVE_WORDS", 1)  # a full table sifts nothing out and loses nothing
    assert exact <= {r.want for r in J.sifted(rows, "want", wanted).collect()}
    assert J.sifted(rows, "want", wanted.limit(0)).collect() == []


def test_join_of_nothing(docs):
    assert J.near_duplicates(docs([])).collect() == []


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in J.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}}
