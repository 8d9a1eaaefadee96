import hashlib

import numpy as np
from llm_fixtures import docs, small  # noqa: F401
from pyspark.sql import functions as F
from vaultline.llm import cuckoo
from vaultline.llm import line_dedup as L
from vaultline.llm.line_dedup import LineIndex, build, keyed_lines

SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows):
    texts = {}
    for i, t in rows:
        texts[i] = t or ""
    owner, seen = {}, {}
    for i, t in texts.items():
        if i is None:
            continue
        for line in t.split("\n"):
            k = lower(line.strip(SPACE))
            if len(k) >= 10:
                seen.setdefault(k, set()).add(i)
    owner = {k: min(v) for k, v in seen.items() if len(v) >= 2}
    out = {}
    for i, t in texts.items():
        lines = t.split("\n")
        kept = [x for x in lines if i is None or owner.get(lower(x.strip(SPACE)), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


ROWS = [
    (3, "Shared line number one\nonly in three here\nshort"),
    (1, "  shared LINE number one \t\nshort\nÉcole École École"),
    (2, "shared line number one\nshared line number one\nécole école école"),
    (7, None), (8, ""), (9, "École École École\n\n\nxx"),
    (None, "shared line number one"), (12, "long " * 5000 + "\nshared line number one"),
]


def results(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in df.collect()}


def test_matches_brute_force(docs):
    d = docs(ROWS)
    assert results(build(d, batches=3).dedup(d)) == brute(ROWS)


def test_deletion_undoes_insertion(docs):
    d = docs(ROWS)
    index = LineIndex(d.sparkSession)
    index.insert(d.filter("doc_id <> 1"))
    before = {(bytes(r.key), r.n_refs, r.owner) for r in index.shared().collect()}
    index.insert(d.filter("doc_id = 1"))
    assert {(bytes(r.key), r.n_refs, r.owner) for r in index.shared().collect()} != before
    index.delete(d.filter("doc_id = 1"))
    assert {(bytes(r.key), r.n_refs, r.owner) for r in index.shared().collect()} == before
    rest = [r for r in ROWS if r[0] != 1]
    assert results(index.dedup(d.filter("doc_id IS NULL OR doc_id <> 1"))) == brute(rest)


def test_texts_that_share_an_id(docs):
    """Rows of one id are one document; each of its texts loses its own lines."""
    rows = [(1, "a line of the first document\nanother line of it"), (2, "A line of the first document\nsecond line of two"),
            (2, "third unique line of two\nanother line of it\nsecond line of two"), (2, None),
            (3, "exactly the same text twice"), (3, "exactly the same text twice")]
    out = build(docs(rows)).dedup(docs(rows))
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in out.collect()) == [
        (1, rows[0][1], 0), (2, "", 0), (2, "second line of two", 1), (2, "third unique line of two\nsecond line of two", 1),
        (3, rows[4][1], 0), (3, rows[4][1], 0)]


def test_any_column_names(docs):
    names = ["n_lines", "n_dropped", "key", "pos", "owner", "positions", "row", "at", "_drop", "batch", "hot_owner", "n", "text_id"]
    d = docs(ROWS)
    for n in names:
        d = d.withColumn(n, F.lit(n))
    out = build(d).dedup(d)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in out.collect()} == brute(ROWS)
    assert {tuple(r[n] for n in names[2:]) for r in out.collect()} == {tuple(names[2:])}


def test_documents_that_are_not_indexed(docs):
    d = docs(ROWS)
    other = docs([(50, "shared line number one\nnew line of a stranger"), (0, "shared line number one")])
    got = results(build(d).dedup(other, indexed=False))
    assert got == {50: (2, 1, "new line of a stranger"), 0: (1, 1, "")}


def test_shards_grow_with_the_keys(docs, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 8)
    monkeypatch.setattr(L, "LEAST_SHARDS", 2)
    rows = [(i, f"a line that only {i} has\na line of group {i % 7}") for i in range(120)]
    d = docs(rows)
    index = LineIndex(d.sparkSession)
    for b in range(3):
        index.insert(d.filter(f"doc_id % 10 {'< 1' if b == 0 else '= 1' if b == 1 else '> 1'}"))
    assert index.shards > 8 and index.filters().count() <= index.shards
    assert index.filters().agg(F.sum("n_keys")).first()[0] == 127
    assert results(index.dedup(d)) == brute(rows)
    index.delete(d.filter("doc_id < 100"))
    rest = [r for r in rows if r[0] >= 100]
    assert results(index.dedup(docs(rest))) == brute(rest)


def test_a_line_is_hashed_once(docs):
    plan = keyed_lines(docs(ROWS)).join(docs([]).select(F.lit(b"x").alias("key")), "key")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("md5") == 1


def test_empty_table(docs):
    d = docs([])
    assert build(d).dedup(d).collect() == []


def test_cuckoo_has_no_false_negatives():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    t = cuckoo.insert(None, keys[:30_000], 30_000)
    t = cuckoo.insert(t, keys[30_000:], 50_000)
    if t is None:
        t = cuckoo.insert(None, keys, 50_000)
    assert cuckoo.contains(t, keys).all()
    other = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert cuckoo.contains(t, other).mean() < 0.002
    gone = cuckoo.remove(t, keys[:1000])
    assert cuckoo.contains(gone, keys[1000:]).all()
    assert cuckoo.contains(gone, keys[:1000]).mean() < 0.01


def test_digest_of_kept_text(spark, small):
    from vaultline.llm.line_dedup import op1_line_dedup
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, (n, k, t) in brute(rows).items()}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op1_line_dedup(spark, small).collect()}
    assert got == want
