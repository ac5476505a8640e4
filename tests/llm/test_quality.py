import math
import random

import numpy as np
import pytest
from llm_cases import awkward
from pyspark.sql import functions as F

from quire.llm import quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_worst_windows_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        count = rng.integers(0, 120, rng.integers(1, 6))
        values, at = np.rint(rng.normal(size=count.sum()) * 1024) / 1024, 0
        found = quality.worst_windows(values, count)
        for n, weight in zip(count, found):
            part, at = values[at : at + n], at + n
            step = quality.WINDOW // 2
            windows = [part[s : s + quality.WINDOW].sum() for s in range(0, max(1, n - step), step)]
            assert weight == min(windows)


def test_cells_stay_in_their_text():
    texts = ["abcdefg", None, "", "abcd", "abcdefg", "é" * 4]
    found, count = quality.cells(texts)
    assert count.tolist() == [3, 0, 0, 0, 3, 4]
    assert (found[:3] == found[3:6]).all()


@pytest.mark.parametrize("kind", ["spread", "equal", "two"])
def test_cut(spark, monkeypatch, kind):
    monkeypatch.setattr(quality, "SORTED_ROWS", 3)
    rng = random.Random(4)
    values = {"spread": [rng.gauss(0, 50) for _ in range(400)], "equal": [2.5] * 30, "two": [1.0] * 20 + [-1e9] * 20}[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 17, 20, 21, len(values)):
        if k <= len(values):
            assert quality.cut(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_top_k_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, quality.good(spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    rows = quality.classify(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows[:100]:
        found, count = quality.cells([texts[r.doc_id]])
        assert r.weight == quality.worst_windows(model.ratios[found], count)[0]
    k = sum(r.weight >= model.threshold for r in rows)
    least = sorted((r.sampling_key for r in rows), reverse=True)[k - 1]
    assert all(r.accepted == (r.sampling_key >= least) for r in rows) and sum(r.accepted for r in rows) == k
    noise = [r.sampling_key - r.weight for r in rows]
    assert abs(np.mean(noise) - 0.5772) < 0.2 and abs(np.std(noise) - math.pi / 6**0.5) < 0.2


def test_query_keeps_clean_and_drops_bad(spark):
    rows = queries.registered()["op10_quality_classifier"](spark, SF_DIR).toPandas()
    both = rows.merge(spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas(), on="doc_id")
    good = (both.quality == 1) & (both.toxic == 0)
    assert both[good].accepted.mean() > 0.97 and both[both.quality == 0].accepted.mean() < 0.4


def test_awkward(spark):
    df = awkward(spark).selectExpr("*", "1 AS _key", "true AS _good", "false AS _train", "7 AS id", "8 AS _place")
    labels = spark.createDataFrame([(6, True), (6, False), (5, True), (None, True), (4, None), (99, True)], "doc_id long, is_good boolean")
    model = quality.fit(df, labels)
    rows = quality.classify(df.selectExpr("*", "1 AS weight"), model).collect()
    assert len(rows) == 9 and {r.weight for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    blank = quality.fit(df, labels.limit(0))
    assert all(r.accepted for r in quality.classify(df, blank).collect())
    assert quality.classify(df.limit(0), model).count() == 0
    assert quality.fit(df.limit(0), labels).threshold == -math.inf


def test_long_clean_texts_stay_and_bad_passages_go(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = quality.good(spark.read.parquet(f"{folder}/labels.parquet")).where("is_good IS NOT NULL")
    model = quality.fit(docs, labels)
    trains = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)) == 0
    rows = docs.join(labels, "doc_id").select("text", "is_good", trains.alias("trains")).orderBy("doc_id").collect()
    clean = [r.text for r in rows if r.is_good and not r.trains]
    bad = [r.text for r in rows if not r.is_good]
    rng = random.Random(3)

    def rejected(texts):
        found, count = quality.cells(texts)
        return (quality.worst_windows(model.ratios[found], count) < model.threshold).mean()

    alone = rejected(bad)
    for n in (10, 50):
        long = [rng.sample(clean, n) for _ in range(150)]
        assert rejected([" ".join(parts) for parts in long]) < 0.02
        assert rejected([" ".join([*parts[:5], rng.choice(bad), *parts[5:]]) for parts in long]) > alone - 0.1
