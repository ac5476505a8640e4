import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward, frame

from quire.llm import lm, queries

SF_DIR = "/root/testdata/sf0.001"


def test_query_tells_good_from_bad(spark):
    rows = queries.registered()["op8_lm_score"](spark, SF_DIR).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    both = rows.merge(labels, on="doc_id")
    good = (both.quality == 1) & (both.toxic == 0)
    assert both[good].score.median() < both[~good].score.median()


@pytest.mark.parametrize("parts,broadcast_rows", [(lm.PARTS, lm.BROADCAST_ROWS), (3, 0)])
def test_whole_by_brute_force(spark, monkeypatch, tmp_path, parts, broadcast_rows):
    monkeypatch.setattr(lm, "PARTS", parts)
    monkeypatch.setattr(lm, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", f"w{rng.randrange(80_000)}", f"v{rng.randrange(50)}"]) for _ in range(rng.randint(0, 900))) for _ in range(800)]
    texts += ["w1 the w2 the w1"] * 30 + [None, "", "... !"]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, int(i % 3 == 0), 0) for i in range(len(texts))]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    words = [(t or "").replace("... !", "").split() for t in texts]
    distinct = len({w for part in words for w in part})
    assert distinct > 50_000

    def model(some):
        unigrams, pairs = Counter(w for part in some for w in part), Counter(p for part in some for p in zip([None, *part], part))
        unigrams[None] = sum(map(bool, some))
        total = sum(unigrams.values()) + distinct + 2
        return lambda a, b: -math.log((pairs[a, b] + lm.PRIOR * (unigrams[b] + 1) / total) / (unigrams[a] + lm.PRIOR))

    losses = [model([part for i, part in enumerate(words) if i % 3 == 0]), model(words)]
    found = {r.doc_id: r for r in queries.registered()["op8_lm_score"](spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    for i, part in enumerate(words):
        row = found[i]
        assert row.n_words == len(part)
        if not part:
            assert row.target_loss is None and row.background_loss is None and row.score is None
            continue
        want = [sum(f(a, b) for a, b in zip([None, *part], part)) / len(part) for f in losses]
        assert np.allclose([row.target_loss, row.background_loss, row.score], [*want, want[0] - want[1]], rtol=0, atol=1e-6)


def test_whole_awkward(spark):
    df = awkward(spark).selectExpr("*", "1 AS _key", "2 AS _target", "3 AS target", "4 AS id", "5 AS text_key")
    assert lm.score_whole(df, df.limit(0).select("doc_id")).count() == 9
    found = lm.score_whole(df, df).collect()
    assert len(found) == 9 and all((r.score is None) == (r.n_words == 0) for r in found)
    assert len({r.score for r in found if r.doc_id == 6}) == 1
    assert lm.score_whole(df.limit(0), df.select("doc_id")).count() == 0
