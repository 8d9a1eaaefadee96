"""BPE with shared chunks, against the tokenizers library."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_fixtures import docs, small  # noqa: F401
from vaultline.llm import chunk_bpe as B

P = pytest.importorskip("public_tokenizers")
FILE = P.path("word_bpe_49k.json")
RNG = np.random.default_rng(3)
WORDS = ["the", "river", "Élan", "don't", "2024", "naïve", "co-op", "end.", "ΟΔΥΣΣΕΥΣ", "x" * 30]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def library(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    ids = t.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def against_library(out, rows):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()), key=str)
    assert got == sorted(((i, *library(t)) for i, t in rows), key=str)


@pytest.fixture(scope="module")
def spec():
    with open(FILE, encoding="utf-8") as f:
        return f.read()


def test_normalising_below_300_only_lowers(spec):
    c = B.Coder(spec)
    assert c.lowers
    for i in range(1, 0x300):
        text = f"Ab{chr(i)}cD 'S{chr(i)} {chr(i) * 3}"
        assert c.encode([text.lower()])[0] == c.packed(c.whole.encode(text, add_special_tokens=False).ids)


def test_cores_encode_alike_in_every_context(spec):
    c = B.Coder(spec)
    passage = prose(400).lower()
    texts = [passage, "a b " + passage + "zz", prose(50).lower() + passage[700:], "漢字" + passage, "x" * 3000, ""]
    chunks = B.Chunks(texts)
    assert {0, 1, 3} <= set(chunks.text) and 4 not in chunks.text
    common = set(chunks.hash[chunks.text == 0]) & set(chunks.hash[chunks.text == 1])
    assert len(common) > 1  # the same passage is cut alike
    assert len(B._agreeing(c, chunks, np.arange(len(chunks.hash)))) == len(chunks.hash)
    for s, e, t in zip(chunks.start, chunks.end, chunks.text):
        lo, hi = chunks.offs[t], chunks.offs[t + 1]
        parts = [bytes(chunks.data[a:b]).decode() for a, b in ((lo, s), (s, e), (e, hi))]
        assert b"".join(c.encode(parts)) == c.packed(c.inner.encode("".join(parts), add_special_tokens=False).ids)


def test_a_core_that_does_not_join_is_given_up(spec):
    class Odd(B.Coder):
        def encode(self, texts):  # a tokenizer that looks across white space
            return [self.packed([len(t)]) + i for t, i in zip(texts, super().encode(texts))]

    chunks = B.Chunks([prose(400).lower()])
    assert len(chunks.hash) and len(B._agreeing(Odd(spec), chunks, np.arange(len(chunks.hash)))) == 0


def test_documents_with_shared_passages(spark, docs, monkeypatch):
    monkeypatch.setattr(B, "SPREAD", 8)  # many cores are salted
    monkeypatch.setattr(B, "WORDS", 20)  # the workers' words are dropped again and again
    shared, other = prose(600), prose(500)
    rows = [(i, prose(30) + " " + shared + prose(20 + i)) for i in range(12)]
    rows += [(20 + i, shared) for i in range(6)] + [(30, other + shared), (31, shared + other + shared), (32, other)]
    rows += [(40, None), (41, ""), (42, " \n\t "), (None, shared), (20, shared), (20, other), (43, "ab" * 5000),
             (44, "漢字かな" * 300 + shared + "漢字"), (45, prose(20000)), (46, "<|endoftext|>"),
             (47, shared + "<|startoftext|>" + shared + "<|ENDOFTEXT|><|endoftext|>"), (48, "J̌ x́ ́ İ ẞ " + other),
             (49, shared.upper()), (50, shared.replace(" ", "\n")), (51, "a" + shared)]
    d = docs(rows).withColumn("key", F.lit("kept out")).withColumn("n_tokens", F.lit(-1))
    against_library(B.encode(d, FILE), rows)


def test_empty_table_and_documents_without_sharing(spark, docs):
    assert B.encode(docs([]), FILE).collect() == []
    rows = [(1, prose(300)), (2, None)]
    against_library(B.encode(docs(rows), FILE), rows)


def test_shared_cores_are_found(spark, docs, spec):
    shared = prose(2000)
    d = docs([(i, shared + f" {i}") for i in range(40)]).repartition(4)
    bits = B.sieve(d, spec)
    normal = B.Coder(spec).normal
    assert B._hit(bits, B.Chunks([normal(shared, True)]).hash[:-1]).all()  # the last one may run on
    lonely = B.Chunks([normal(prose(2000), True)]).hash
    assert B._hit(bits, lonely).mean() < 0.1


def test_tokenizers_with_white_space_in_pieces_are_refused():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        with pytest.raises(ValueError):
            B.Coder(f.read())


def test_whole_table_against_the_library(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    against_library(B.op12_chunk_bpe(spark, small), rows)
