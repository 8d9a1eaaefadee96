"""Empty tables, very long texts, repeated ids and clashing columns, operator by operator."""
import math

import numpy as np
import pytest
from llm_fixtures import docs, small  # noqa: F401
from test_text_operators import brute_base
from vaultline.llm import kneser_ney, quality, secrets, site_style
from vaultline.llm.registry import queries

RNG = np.random.default_rng(12)
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}


def tables(spark, folder, **rows):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows.get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("key", sorted(queries()))
def test_empty_tables(spark, tmp_path, key):
    assert queries()[key](spark, tables(spark, tmp_path)).collect() == []


@pytest.mark.parametrize("key", sorted(k for k in queries() if k not in ("op2_site_style", "op11_whitening", "op13_hard_negatives")))
def test_odd_documents(spark, tmp_path, key):
    """NULLs in every column, empty, blank, very long and repeated texts and ids."""
    words = [f"w{i}" for i in range(300)]
    long = " ".join(RNG.choice(words, 60_000))
    texts = [None, "", " \n\t ", "x", long, "one line\n" * 3000, "é" * 5000, "a b c d e f", "a b c d e f"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id at all here", None, None, None), (None, None, None, None, None), rows[3], (7, "another text of an id", "en", "s", 21)]
    labels = [(0, 1, 0), (3, 0, 1), (3, None, None), (None, 1, 1), (4, 1, 0), (7, 0, 1), (99, 1, 1)]
    folder = tables(spark, tmp_path, documents=rows, labels=labels, benchmark=[(1, "w1 w2"), (None, "a b c"), (2, None), (3, "")])
    out = queries()[key](spark, folder).collect()
    if key == "op9_mixing":
        return
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in out)
    given = sorted((r[0] is not None, r[0] or 0) for r in rows)
    if key == "op10_ngram_jaccard":  # a row per id (and text); rows without an id stand outside
        assert {i for has, i in ids if has} == {i for has, i in given if has}
    else:
        assert ids == given


# --- quality ---

def test_posterior_against_plain_densities():
    k = len(quality.STATISTICS)
    a = RNG.normal(size=(2, k, k))
    cov = a @ a.transpose(0, 2, 1) + np.eye(k)
    mean, prior = RNG.normal(size=(2, k)), np.array([0.3, 0.7])
    factor = np.linalg.cholesky(cov)
    model = quality.Model(mean, np.linalg.inv(factor), np.log(prior) - np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(1))
    x = RNG.normal(size=(50, k)) * 2
    dense = np.array([[prior[c] * math.exp(-0.5 * (v - mean[c]) @ np.linalg.solve(cov[c], v - mean[c]))
                       / math.sqrt(np.linalg.det(2 * math.pi * cov[c])) for c in (0, 1)] for v in x])
    assert quality.posterior(model, x) == pytest.approx(dense[:, 1] / dense.sum(1), abs=1e-9)


def test_fit_against_plain_moments(spark):
    k = len(quality.STATISTICS)
    y = RNG.integers(0, 2, 400)
    x = RNG.normal(size=(400, k)) * (1 + y[:, None]) + y[:, None]
    rows = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(y, x)] + [(7, [0.0] * k)], "y int, x array<double>")
    model = quality.fit(rows.repartition(5))
    for c in (0, 1):
        z = x[y == c]
        assert model.means[c] == pytest.approx(z.mean(0))
        pool = max(quality.POOL, k / (k + len(z)))
        pooled = sum((y == d).sum() * np.cov(x[y == d].T, bias=True) for d in (0, 1)) / 400
        s = (1 - quality.RIDGE) * ((1 - pool) * np.cov(z.T, bias=True) + pool * pooled) + quality.RIDGE * np.diag(np.diag(pooled) + 1e-3)
        assert model.whiten[c] @ s @ model.whiten[c].T == pytest.approx(np.eye(k), abs=1e-8)
        assert model.constant[c] == pytest.approx(math.log(((y == c).sum() + 1) / 402) - 0.5 * np.linalg.slogdet(s)[1])


# --- secrets ---

def test_many_matches_in_one_text(spark, docs):
    text = " ".join(f"token={i:06d}abc AKIA{i:016d} {i:024x}" for i in range(2500))
    r = secrets.scan(docs([(1, text)])).first()
    assert (len(r.assign), len(r.access), len(r.hex)) == (2500, 2500, brute_base(text).count("hex"))


def test_normal_tail(spark):
    z = [-8.0, -1.0, 0.0, 0.3, 1.0, 2.49, 2.51, 4.0, 7.0, 12.0, 30.0, 36.0]
    got = spark.createDataFrame([(v,) for v in z], "z double").selectExpr(f"{secrets._tail('z')} AS p").collect()
    for v, r in zip(z, got):
        assert r.p == pytest.approx(math.erfc(v / math.sqrt(2)) / 2, rel=1e-5)


LETTERS = "etaoinshrdlucmfwypvbgkjqxz"
SHARES = np.array([12.7, 9.1, 8.2, 7.5, 7.0, 6.7, 6.3, 6.1, 6.0, 4.3, 4.0, 2.8, 2.8, 2.4, 2.2, 2.4, 2.0, 1.9, 1.0, 1.5, 2.0, 0.8, 0.15, 0.1, 0.15, 0.07])


def random_token(k, n):
    return "".join(RNG.choice(list(secrets._ALPHABETS[k]), n))


def plain_token(n):
    """Letters of ordinary frequencies in words of path-like tokens."""
    out = "".join(RNG.choice(list(LETTERS), n, p=SHARES / SHARES.sum()))
    return out[: n // 2] + "/" + out[n // 2 + 1 :] if n % 3 == 0 else out


def test_battery_of_random_tokens_keeps_its_level(spark):
    """P-values of random tokens of any encoding and length are not too small."""
    rows = [(k, n, random_token(k, n)) for k in ("hex", "b32", "aln", "b64") for n in (24, 40, 64, 128) for _ in range(250)]
    got = secrets.with_battery(spark.createDataFrame(rows, "k string, n int, token string")).collect()
    for level in (0.1, 0.01):
        share = np.mean([r.p_random < level for r in got])
        assert share < 1.5 * level
    by = {n: np.mean([r.p_random < 0.05 for r in got if r.n == n]) for n in (24, 40, 64, 128)}
    assert max(by.values()) < 0.08
    text = secrets.with_battery(spark.createDataFrame([(plain_token(n),) for n in (64, 128) for _ in range(200)], "token string")).collect()
    assert np.mean([r.p_random < 0.01 for r in text]) > 0.9


def test_realised_false_discoveries_by_length(spark):
    """Random tokens planted among plain ones: few false discoveries in every stratum."""
    rows = []
    for n in (22, 28, 40, 64, 120):
        rows += [(n, True, random_token(("aln", "b64")[i % 2], n)) for i in range(60)]
        rows += [(n, False, plain_token(n)) for _ in range(600)]
    tested = secrets.with_battery(spark.createDataFrame(rows, "n int, planted boolean, token string"))
    got = secrets.decided(tested).collect()
    for n in (22, 28, 40, 64, 120):
        found = [r.planted for r in got if r.n == n and r.random]
        assert found and 1 - np.mean(found) <= 0.05
        assert sum(found) >= (50 if n >= 28 else 30)


# --- site style ---

def test_a_very_long_page(spark):
    body = "".join(f"<p>Paragraph {i} &amp; more</p>" for i in range(20_000))
    page = f"<html><body><nav>menu</nav><article><h1>T</h1>{body}</article><footer>foot</footer></body></html>"
    df = spark.createDataFrame([(1, "http://a.example/x", page, "r")], "page_id long, url string, html string, row string")
    out = site_style.extract(df, ["page_id", "row"]).first()
    assert out.text.split("\n") == ["T", *[f"Paragraph {i} & more" for i in range(20_000)]] and out.row == "r"


# --- language model ---

def test_a_folder_without_a_scheme_gets_one(spark, tmp_path):
    assert kneser_ney.qualified(spark, str(tmp_path)).startswith("file:/")
    assert kneser_ney._local(kneser_ney.qualified(spark, str(tmp_path))) == str(tmp_path)
    assert kneser_ney._local("hdfs://host/a") is None and kneser_ney._local("/a") is None
