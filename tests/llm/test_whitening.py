import math
import random

import numpy as np
import pytest

from quire.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, id string, x int"


def plain(rows):
    """What the operator is to return, by NumPy's eigenvalues: (deviation, |whitened|, explained) per row and component."""
    usable = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in usable), default=0)
    usable = [(i, tuple(v + [1_000_000] * (width - len(v)))) for i, v in usable]
    fit = sorted({v for _, v in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = [j for j in np.argsort(-values) if values[j] > 1e-9 * values.max()][:16]
    out = []
    for i, v in usable:
        off = [n * c - s for c, s in zip(v, sums, strict=True)]
        z = np.array(off) / n @ vectors[:, order] / np.sqrt(values[order])
        out += [(i, k, n, sum(o * o for o in off), z[k - 1], values[j] / values.sum()) for k, j in enumerate(order, start=1)]
    return out


def check(found, wanted, near=1e-7):
    found = sorted((tuple(r) for r in found), key=lambda r: (str(r[0]), r[1], r[3]))
    wanted = sorted(wanted, key=lambda r: (str(r[0]), r[1], r[3]))
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert abs(abs(a[4]) - abs(b[4])) < near * max(1, abs(b[4])) and abs(a[5] - b[5]) < 1e-9 and a[6] < 1e-4


@pytest.mark.parametrize("d, n", [(5, 40), (24, 300)])
def test_brute_force(spark, d, n):
    rng = random.Random(d)
    rows = [(i, [rng.gauss(j, 3.0 / (1 + j)) for j in range(d)]) for i in range(n)]
    rows += rows[:7] + [(None, rows[0][1]), (1000, None), (1001, [None] * d), (1002, [math.nan] * d), (1003, [math.inf] * d), (1004, rows[1][1][:-1])]
    df = spark.createDataFrame([(i, v, "clash", 3) for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    check(got, plain(rows))
    signs = {}
    for r, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1], r[3])), sorted(plain(rows), key=lambda r: (str(r[0]), r[1], r[3])), strict=True):
        if abs(w[4]) > 1e-6:
            signs.setdefault(r[1], set()).add(r[4] * w[4] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_few(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)).collect() == []
    rows = [(1, [1.0, 2.0, 5.0]), (2, [2.0, 4.0, 5.0])]
    check(whitening.whiten(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)).collect(), plain(rows))


def test_far_entries(spark):
    """Entries that products of 64 bits cannot hold are summed as doubles; deviations beyond 64 bits are null."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1e12), rng.gauss(0, 1e9), rng.gauss(0, 1e11)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)).collect()
    wanted = plain(rows)
    assert {r["deviation"] for r in got} == {None} and got[0]["identity_error"] < 1e-4
    check([(*r[:3], 0, *r[4:]) for r in got], [(*w[:3], 0, *w[4:]) for w in wanted], near=1e-5)
    held = spark.createDataFrame([(i, [s * 1e300, 0.0], "", 0) for i, s in enumerate((1, -1, 0))], SCHEMA)
    assert {r["component"] for r in whitening.whiten(held).collect()} == {1}


def test_factor():
    rng = np.random.default_rng(5)
    for d, rank in ((6, 6), (7, 3), (1, 1), (33, 20)):
        half = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 3, rank)
        a = half @ half.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, a)
        w = whitening.orthogonal_columns(factor)
        gram = w.T @ w
        assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-12 * gram.max()
        vectors, values = whitening.components(a, 1)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1][: len(values)]) and np.allclose(a @ vectors, vectors * values)


def test_query(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(queries.registered()["op13_embedding_whitening"](spark, SF_DIR).collect(), plain(rows))
