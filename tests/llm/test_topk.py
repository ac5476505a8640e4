import math
import random

import numpy as np
import pytest
from llm_cases import duck, same
from pyspark.sql import functions as F

from quire.llm import oracle, queries, topk

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, score string"


def plain(rows, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 5 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in usable if i != q]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], start=1)]
    return sorted(out)


def found(spark, rows, k):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, k).collect()))


@pytest.mark.parametrize("kind", ["ties", "spread", "odd"])
def test_brute_force(spark, monkeypatch, kind):
    rng = random.Random(kind)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    step = {"ties": lambda: rng.choice([-1, 0, 0, 1]) / 256, "spread": lambda: rng.gauss(0, 1)}.get(kind)
    if step:
        rows = [(i, [step() for _ in range(6)], "x") for i in range(130)]
    else:
        rows = [(0, [0.0, 0.0], "x"), (5, [1.0], "x"), (5, [1.0], "x"), (10, [], "x"), (15, None, "x"), (20, [1.0, None], "x"),
                (25, [float("nan")], "x"), (30, [float("inf")], "x"), (None, [1.0], "x"), (3, [2.0, -1.0, 7.0], "x"),
                (4, [2.0, -1.0, 7.0], "x"), (35, [1e300, 1.0], "x"), (36, [-1e300], "x")]
    assert found(spark, rows, 5) == plain(rows, 5)


def test_empty(spark):
    assert found(spark, [], 5) == [] and found(spark, [(5, [1.0], "x")], 5) == []


def test_stops_early():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-5, 5, (5000, 4))
    vectors[:8] = 100
    block, met = topk.Block(np.arange(5000), vectors), []
    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                met.append(len(key))
            return super().__getitem__(key)

    block.vectors = block.vectors.view(Seen)
    rows, scores = block.best(-1, np.array([3, 2, 5, 1]), 5)
    assert list(rows) == [0, 1, 2, 3, 4] and set(scores) == {1100} and sum(met) < 500


def test_query(spark):
    found_ = queries.registered()["op3_topk_search"](spark, SF_DIR)
    same(found_, duck(SF_DIR).execute(oracle.statements()["op3_topk_search"]).df())
