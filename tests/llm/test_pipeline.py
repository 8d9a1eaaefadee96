import hashlib
import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from llm_fixtures import docs, small  # noqa: F401
from test_line_dedup import brute as brute_lines
from test_models_and_pairs import brute_groups
from test_text_operators import brute_hits


def test_registered(spark):
    keys = E.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in keys} and "pipeline" in keys


def stage(spark, name, docs, sf_dir):
    return dict(C.STAGES)[name](spark, docs, sf_dir)


def test_stages_match_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("key", F.lit("x")).withColumn("n_lines", F.lit(1))
    extra = spark.createDataFrame([(None, None, "en", "s", 0, "x", 1), (7001, "", "en", None, 0, "x", 1)], docs.schema)
    docs = docs.unionByName(extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = stage(spark, "line_dedup", docs, small)
    assert out.columns == docs.columns
    want = brute_lines(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    assert all((r.text or "") == want[i][2] and r.n_chars == (len(r.text) if r.text is not None else None) for i, r in got.items())

    out = stage(spark, "near_duplicates", docs, small)
    groups = brute_groups(rows)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({c for c, _, _ in groups.values()})

    out = stage(spark, "decontaminate", docs, small)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    hits = brute_hits(rows, items)
    same = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and len(same) == len(rows)
    before = dict(rows)
    assert all((same[i] == before[i]) == (hits[i][1] == 0) for i in before)


def test_toxicity_stage(spark, small):
    # 87 labels teach little here; no clean document may go all the same.
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    out = stage(spark, "toxicity", docs, small)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns and {i for i, t in labels.items() if not t} <= kept
    larger = small.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    kept = {r.doc_id for r in stage(spark, "toxicity", docs, larger).collect()}
    assert {i for i, t in labels.items() if not t} <= kept
    # The other languages have four to six toxic labels each in this table,
    # too few to tell their words from chance.
    english = {r.doc_id for r in docs.filter("lang = 'en'").collect()}
    toxic = {i for i, t in labels.items() if t and i in english}
    assert len(toxic & kept) <= 0.1 * len(toxic)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_cut(text, items, window=10):
    """The text without the runs of words that lie in an item's windows."""
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    grams = set()
    for t in items:
        w = WORD.findall(lower(t))
        k = min(window, len(w))
        grams |= {tuple(w[a : a + k]) for a in range(len(w) - k + 1 if w else 0)}
    found = list(WORD.finditer(lower(text)))
    words, hit = [m[0] for m in found], set()
    for k in {len(g) for g in grams}:
        for a in range(len(words) - k + 1):
            if tuple(words[a : a + k]) in grams:
                hit.update(range(a, a + k))
    out, at = [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out.append(text[at : found[i].start()])
        at = found[i].end()
    return "".join(out) + text[at:]


def brute_copies(rate, doc_id):
    u = int(hashlib.md5(f"{doc_id}|mix-1".encode()).hexdigest()[:13], 16) / 2**52
    k, p, cum = 0, math.exp(-rate), math.exp(-rate)
    while cum <= u:
        k += 1
        p *= rate / k
        cum += p
    return k


def test_run_matches_brute_force(spark, small):
    """All stages in plain Python, from the documents that the classifier keeps."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: (r.text, r.source) for r in stage(spark, "toxicity", docs, small).collect()}
    lines = brute_lines([(i, t) for i, (t, _) in rows.items()])
    texts = {i: lines[i][2] if rows[i][0] is not None else None for i in rows}
    kept = {c for c, _, _ in brute_groups(list(texts.items())).values()}
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    cut = {i: texts[i] and brute_cut(texts[i], items) for i in kept}
    size = Counter(rows[i][1] for i in kept)
    want = {}
    for i in kept:
        n = brute_copies(len(kept) / len(size) / size[rows[i][1]], i)
        want |= {(i, c): (cut[i], rows[i][1], n) for c in range(1, n + 1)}
    out = C.run(spark, small)
    assert set(docs.columns) | {"copy", "n_copies", "rate", "shuffle_key"} == set(out.columns)
    got = out.collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.text, r.source, r.n_copies) == want[r.doc_id, r.copy]
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_stages_keep_columns_of_any_name(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    for n in ["severity", "_severity", "positions", "row", "item", "extra", "_extra", "starts", "items", "rate_", "mix_rate",
              "mix_source", "block", "key", "n", "text_id", "tile", "hits"]:
        docs = docs.withColumn(n, F.lit(n))
    for name, _ in C.STAGES:
        out = stage(spark, name, docs, small)
        assert set(docs.columns) <= set(out.columns)
        assert {r.mix_rate + r._extra + r.items for r in out.select("mix_rate", "_extra", "items").collect()} <= {"mix_rate_extraitems"}
        if name != "mixing":
            assert out.columns == docs.columns
            docs = out


def test_stages_of_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, _ in C.STAGES:
        assert stage(spark, name, docs, small).collect() == []


@pytest.mark.parametrize("key", ["op1_line_dedup", "op9_mixing"])
def test_sql(spark, small, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    df = E.queries()[key](spark, small)
    assert sorted(df.columns) == sorted(cols)
    canon = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(canon(x) for x in r) for r in df.select(*cols).collect())
    assert got == sorted(tuple(canon(x) for x in r) for r in res.fetchall())
