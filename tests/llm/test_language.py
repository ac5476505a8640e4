import zlib

import numpy as np
import pytest
from llm_cases import awkward, frame
from pyspark.sql import functions as F

from quire.llm import language, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return language.fit(language.sample(docs.where(~language.held_out(F.col("doc_id"))), 60))


def test_forward_backward():
    rng = np.random.default_rng(0)
    k = 3
    model = language.Model(list("abc"), None, {}, None, rng.normal(size=k), rng.normal(size=(k, k)))
    for lengths in ([1], [64], [65], [5, 200, 64, 128, 1, 129, 700]):
        lengths = np.array(lengths)
        scores = rng.normal(size=(lengths.sum(), k)) * 2
        found, at = language.marginals(model, scores, lengths), 0
        for n in lengths:
            factors, moves = np.exp(scores[at : at + n]), np.exp(model.moves)
            forward, backward = np.zeros((n, k)), np.ones((n, k))
            forward[0] = np.exp(model.start) * factors[0]
            for t in range(1, n):
                forward[t] = forward[t - 1] @ moves * factors[t]
                forward[t] /= forward[t].sum()
            for t in range(n - 2, -1, -1):
                backward[t] = moves @ (backward[t + 1] * factors[t + 1])
                backward[t] /= backward[t].sum()
            both = forward * backward
            assert np.allclose(found[at : at + n], both / both.sum(axis=1, keepdims=True))
            at += n


def test_gradient():
    rng = np.random.default_rng(1)
    k, length = 3, 6
    model = language.Model(list("abc"), None, {}, None, rng.normal(size=k), rng.normal(size=(k, k)))
    emit, gold = rng.normal(size=(2, length, k)), rng.integers(0, k, (2, length))

    def loss(emit, start, moves):
        total = 0.0
        for e, g in zip(emit, gold):
            state = start + e[0]
            for t in range(1, length):
                state = np.log(np.exp(state[:, None] + moves).sum(axis=0)) + e[t]
            path = start[g[0]] + e[np.arange(length), g].sum() + moves[g[:-1], g[1:]].sum()
            total += np.log(np.exp(state).sum()) - path
        return total

    found = language._gradient(model, emit, gold)
    for which, value in enumerate((emit, model.start, model.moves)):
        for place in list(np.ndindex(value.shape))[::5]:
            parts = [emit.copy(), model.start.copy(), model.moves.copy()]
            parts[which][place] += 1e-6
            up = loss(*parts)
            parts[which][place] -= 2e-6
            assert np.isclose(found[which][place], (up - loss(*parts)) / 2e-6, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.registered()["op2_language_id"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.98


def test_code_switched(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(language.held_out(F.col("doc_id"))).toPandas()
    fr, de = (docs[docs.lang == lang].text.tolist()[:20] for lang in ("fr", "de"))
    texts = [" ".join(a.split()[:30] + b.split()[:30]) for a, b in zip(fr, de)]
    right = total = 0
    for row in language.label_words(frame(spark, texts), model).collect():
        n = len(language.words_of(" ".join(fr[row.doc_id].split()[:30])))
        wanted = ["fr"] * n + ["de"] * (len(row.words) - n)
        right, total = right + sum(a == b for a, b in zip(row.labels, wanted)), total + len(wanted)
    assert right / total > 0.95


def test_awkward(spark, model):
    df = awkward(spark).selectExpr("*", "'de' AS lang_pred", "2 AS score")
    rows = language.predict(df, model).collect()
    assert len(rows) == 9
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred in model.labels and 0 <= r.score <= 1 for r in rows if r.doc_id in (None, 4, 5, 6))
    assert language.predict(df.limit(0), model).count() == 0
    none = language.fit([])
    assert {r.lang_pred for r in language.predict(df, none).collect()} == {"und"}
    assert language.predict(frame(spark, ["12 34 ²"]), model).first().lang_pred == "und"
