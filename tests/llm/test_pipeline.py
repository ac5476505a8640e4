"""The pipeline, stage by stage, against the operators' own results and plain Python."""

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from test_decontaminate import plain as plain_hits
from test_neardup import plain as plain_components
from test_neardup import plain_sets
from test_secrets import plain_spans

import corpus_pipeline
from quire.llm import bpe, quality, secrets
from quire.llm.common import written

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE encoding and decoding"
    ]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = docs
        docs = written(stage(spark, docs, SF_DIR), "test-pipeline")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name == "quality classifier":
            model = quality.fit(given, quality.good(spark.read.parquet(f"{SF_DIR}/labels.parquet")))
            wanted = {r.doc_id for r in quality.classify(given, model).where("accepted").collect()}
            assert set(kept[name]) == wanted and all(kept[name][i] == before[i] for i in wanted)
        if name == "MinHash near-dedup":
            texts = [(i, r.text) for i, r in kept["quality classifier"].items()]
            assert set(kept[name]) == {i for i, (_, _, stays) in plain_components(sorted(texts), corpus_pipeline.NEAR_PERCENT).items() if stays}
        if name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
            texts = [(i, r.text) for i, r in kept["MinHash near-dedup"].items()]
            assert set(kept[name]) == {i for i, _, n, _ in plain_hits(texts, items) if n == 0}
        if name == "secret scans":
            ratios = secrets.train(secrets.labelled_tokens(spark, given))
            assert set(kept[name]) == set(kept["benchmark decontamination"])
            for i, r in kept["benchmark decontamination"].items():
                out, at = [], 0
                for start, _, _, end, _ in plain_spans(r.text, ratios):
                    out += [r.text[at:start], secrets.MASK] if start >= at else []
                    at = max(at, end)
                assert kept[name][i].text == "".join(out) + r.text[at:]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    with open(corpus_pipeline.RANKS, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id for r in last} == set(kept["secret scans"])
    for r in last:
        text = kept["secret scans"][r.doc_id].text
        assert np.frombuffer(r.token_ids, "<u4").tolist() == library.encode_ordinary(text) and r.n_tokens * 4 == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


#: Columns of other tables and of the operators' own work.
CLASHING = "doc_id, text, lang, source, n_chars, 1 AS kept, 2 AS text_key, 'r' AS row, true AS _good, 3 AS _key, 's' AS secrets, 't' AS masked, 4 AS n_hit, 5 AS id, 6 AS accepted".split(", ")


def awkward_documents(spark):
    same = "same words here for all of us, said once and said again"
    texts = [(1, same), (1, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (None, "no id at all but some words"), (None, "no id at all but some words"),
             (6, "漢字 🙂 … ¿ñ?"), (7, "x" * 300_000), (8, "long text of many words " * 20_000), (9, "token = 'abcdef0123456789abcdef' and more"), (9, "other text of nine")]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(*CLASHING)


def test_awkward_rows_through_all_stages(spark):
    given = docs = awkward_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(stage(spark, docs, SF_DIR), "test-pipeline")
        assert docs.schema.names == given.schema.names and docs.count() <= before.count()
        others = [c for c in given.columns if c not in ("text", "n_chars")]
        assert docs.select(*others).exceptAll(before.select(*others)).isEmpty()
    rows = docs.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) <= 1 and ids.count(2) <= 1 - ids.count(1) and not any("abcdef0123456789abcdef" in (r.text or "") for r in rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in last)
    assert {r.n_tokens for r in last if r.doc_id in (3, 4)} <= {0}


def test_stages_without_the_classifier(spark):
    """Which of the awkward rows near-dedup, decontamination and masking keep."""
    docs = awkward_documents(spark)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = written(stage(spark, docs, SF_DIR), "test-pipeline")
    rows = docs.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "4", "5", "6", "7", "8", "9", "9", "None"]
    assert {r.text for r in rows if r.doc_id == 9} == {f"{secrets.MASK}' and more", "other text of nine"}
    assert next(r for r in rows if r.doc_id == 3).text is None


def test_empty_table_through_all_stages(spark):
    docs = awkward_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), "test-pipeline")
        assert docs.count() == 0


def pairs_of_texts():
    """(id, text): pairs whose sets have similarities from 0.7 to 0.95, many between 0.80 and 0.85."""
    rng = random.Random(9)
    rows = []
    for i in range(60):
        base = [f"p{i}w{rng.randrange(10_000)}" for _ in range(rng.randint(60, 160))]
        copy = list(base)
        for at in rng.sample(range(10, len(base) - 10), rng.randint(1, 3)):
            copy[at] = f"other{i}at{at}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    return rows


def test_near_copies_of_80_percent(spark):
    rows = pairs_of_texts()
    sets = plain_sets([text for _, text in rows])
    shares = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert sum(0.80 <= x < 0.85 for x in shares) >= 5 and min(shares) < 0.80
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()}
    assert kept == {2 * i for i in range(60)} | {2 * i + 1 for i, x in enumerate(shares) if x < 0.80}
