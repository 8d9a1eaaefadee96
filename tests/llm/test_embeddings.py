"""Embedding whitening and hard-negative mining."""
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_fixtures import small  # noqa: F401
from vaultline.llm import hard_negatives as H
from vaultline.llm import whitening as W
from vaultline.llm.vectors import exact_products

VECS = "vec_id long, label int, embedding array<float>"
RNG = np.random.default_rng(8)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def ints(v, d):
    return [math.floor(256 * c) for c in v] + [0] * (d - len(v))


def floats(*shape):
    return RNG.normal(0, 0.1, shape).astype(np.float32).tolist()


# --- spectrum slicing ---

def test_inertia_counts_eigenvalues():
    for d in (1, 2, 3, 9, 30):
        for i in range(10):
            a = RNG.standard_normal((d, d))
            a = a + a.T
            if i % 3 == 0 and d > 1:
                np.fill_diagonal(a, 0)
            w = np.linalg.eigvalsh(a)
            assert W.inertia(a) == ((w < 0).sum(), 0, (w > 0).sum())
    assert W.inertia(np.zeros((4, 4))) == (0, 4, 0)
    assert W.above(np.diag([3.0, 2.0, 1.0]), 1.5) == 2


def test_leading_pairs_also_with_ties():
    b = RNG.standard_normal((40, 20))
    close = np.diag([4.0, 4.0 - 1e-9, 3.0, 1.0, 0.5])
    q = np.linalg.qr(RNG.standard_normal((5, 5)))[0]
    for v in (b.T @ b, np.eye(6), np.diag([2.0, 2, 2, 1, 0]), q @ close @ q.T, np.zeros((3, 3)), np.array([[2.5]])):
        v = (v + v.T) / 2
        e, u = W.leading(v, 4)
        top = np.linalg.eigvalsh(v)[::-1][:4]
        size = max(1.0, abs(v).max())
        assert np.abs(e - top).max() < 1e-12 * size
        assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
        assert np.abs(v @ u - u * e).max() < 1e-12 * size


# --- whitening ---

def check_whitening(rows, got, k=4):
    good = [(i, v) for i, _, v in rows if usable(v)]
    d = max(len(v) for _, v in good)
    x = {v: None for v in (tuple(ints(v, d)) for _, v in good)}
    fit = np.array(list(x), dtype=float)
    n, s = len(fit), [sum(c) for c in zip(*x)]
    cov = np.cov(fit.T, bias=True).reshape(d, d)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    parts = int((e > W.FLAT * np.trace(cov)).sum())
    assert len(got) == len(good) * parts
    sides = {}
    expect = sorted(((i, c + 1, n, sum((n * a - b) ** 2 for a, b in zip(ints(v, d), s)),
                      (np.array(ints(v, d)) - fit.mean(0)) @ u[:, c] / math.sqrt(e[c]), e[c] / np.trace(cov))
                     for i, v in good for c in range(parts)), key=lambda r: (r[0] is not None, r[0], r[1], r[3]))
    found = sorted(got, key=lambda r: (r.vec_id is not None, r.vec_id, r.component, r.deviation))
    for r, (i, c, n_, dev, w, share) in zip(found, expect):
        assert (r.vec_id, r.component, r.n, r.deviation, r.deviation_exact) == (i, c, n_, dev, dev)
        side = sides.setdefault(c, 1.0 if abs(r.whitened - w) < 1e-9 else -1.0) if abs(w) > 1e-6 else sides.get(c, 1.0)
        assert r.whitened == pytest.approx(side * w, abs=1e-8)
        assert r.explained == pytest.approx(share, rel=1e-9) and r.identity_error < 1e-9


def test_whitening_against_numpy(spark):
    rows = [(i, 0, v) for i, v in enumerate(floats(120, 9))]
    rows += [(7, 0, rows[7][2]), (500, 3, rows[9][2]), (None, None, rows[2][2]), (501, 1, None),
             (502, 1, [0.1, None] + [0.0] * 7), (503, 1, [float("nan")] * 9), (504, 1, [float("inf")] + [0.0] * 8),
             (505, 1, [0.25, -0.5]), (506, 1, []), (507, 1, [0.0] * 9)]
    df = spark.createDataFrame(rows, VECS).withColumn("x", F.lit("kept out")).withColumn("n", F.lit(1))
    check_whitening(rows, W.whiten(df).collect())


def test_whitening_of_few_or_flat_rows(spark):
    make = lambda rows: W.whiten(spark.createDataFrame(rows, VECS)).collect()
    assert make([]) == [] == make([(1, 0, None)]) == make([(1, 0, [])])
    assert make([(1, 0, [0.5, 0.25]), (2, 0, [0.5, 0.25])]) == []  # one distinct vector: no variance
    line = [(1, 0, [0.0, 0.5]), (2, 0, [0.25, 0.5]), (3, 0, [1.0, 0.5])]
    got = make(line)  # one dimension varies
    assert {r.component for r in got} == {1} and len(got) == 3
    check_whitening(line, got)


def test_deviation_beyond_a_long():
    x = np.array([[1, -2], [2**28, 5]], dtype=np.int64)
    long, exact = W._deviations(x, 10**7, [3, -4])
    want = [sum((10**7 * int(c) - s) ** 2 for c, s in zip(row, [3, -4])) for row in x]
    assert [int(v) for v in exact.to_pylist()] == want and long.to_pylist() == [want[0], None]


def test_whitening_of_the_table(spark, small):
    got = W.op11_whitening(spark, small).collect()
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check_whitening(rows, got)


# --- hard negatives ---

def brute(rows, step=10, k=5):
    d = max([len(v) for _, _, v in rows if usable(v)], default=0)
    rows = {(i, c, tuple(ints(v, d))) for i, c, v in rows if None not in (i, c) and usable(v)}
    out = set()
    for i, c, v in rows:
        if i % step:
            continue
        scored = {(-sum(a * b for a, b in zip(v, w)), j, e == c) for j, e, w in rows if j != i}
        same = sorted({(s, j) for s, j, m in scored if m})[:k]
        for s, j in same:
            fits = sorted({(t, o) for t, o, m in scored if not m and 80 * -s <= 100 * -t <= 100 * -s})[:k]
            out |= {(i, j, r + 1, o, -s, -t) for r, (t, o) in enumerate(fits)}
    return out


def mined(spark, rows, step=10):
    df = spark.createDataFrame(rows, VECS).withColumn("length", F.lit("kept out")).withColumn("target", F.lit(1))
    got = [tuple(r) for r in H.mine(df, F.col("vec_id") % step == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("bucket,block", [(2048, 1 << 21), (16, 64)])
def test_negatives_against_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(H, "BUCKET", bucket)
    monkeypatch.setattr(H, "BLOCK", block)
    centres = np.array(floats(6, 8)) * 4
    rows = [(i, i % 3, (centres[i % 6] * (1 + i % 4) + np.array(floats(8))).astype(np.float32).tolist())
            for i in range(200)]
    rows += [(300 + i, i % 3, rows[20][2]) for i in range(40)]  # equal vectors: ties by id
    rows += [rows[0], rows[10], (10, 2, rows[11][2]), (-20, 1, rows[3][2]), (400, 1, [0.0] * 8), (401, 2, [0.5]),
             (402, 2, []), (410, None, rows[5][2]), (None, 1, rows[5][2]), (420, 1, None), (430, 1, [None] * 8),
             (440, 1, [float("nan")] * 8), (450, 0, (-np.array(rows[0][2])).tolist())]
    assert mined(spark, rows) == brute(rows)


def test_negatives_of_empty_and_small_tables(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(0, 1, [1.0, 0.0]), (1, 2, [1.0, 0.0])]) == set()  # no positive
    three = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.1])]
    assert mined(spark, three) == brute(three) != set()
    zero = [(0, 1, [0.0]), (1, 1, [0.0]), (2, 2, [0.0]), (3, 2, [1.0])]
    assert mined(spark, zero) == {(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)}


def test_pruning_keeps_every_reachable_row():
    x = RNG.normal(0, 1, (600, 16))
    x[500:] = x[0] + RNG.normal(0, 0.1, (100, 16))  # a dense group
    x = np.round(160 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    length = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    b = H.Bucket(np.arange(600), np.zeros(600, int), length, x)
    q = H.Queries(np.arange(5), np.zeros(5, int), x[[0, 1, 2, 510, 520]])
    scores = exact_products(q.x, b.x.T)
    pruned = 0
    for share in (0.2, 0.6, 0.9, 0.99):
        least = np.floor(share * scores.max(axis=1)).astype(np.int64)
        got = np.zeros(scores.shape, dtype=bool)
        for who, rows in b.candidates(q, np.arange(5), least):
            got[np.ix_(who, np.arange(600) if rows is None else rows)] = True
            pruned += rows is not None and len(rows) < 300
        assert got[scores >= least[:, None]].all()
    assert pruned


def test_sums_stay_exact():
    big = np.full((1, 4), 2**28, dtype=np.int64)
    assert exact_products(big, big.T)[0, 0] == 2**58
    with pytest.raises(OverflowError):
        exact_products(big * 2**3, big.T * 2**3)


def test_negatives_of_the_table_against_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    want = {tuple(r) for r in con.sql(H.OP13_SQL).fetchall()}
    assert {tuple(r) for r in H.op13_hard_negatives(spark, small).collect()} == want != set()
