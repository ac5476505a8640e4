import random

import pytest
from llm_cases import awkward
from tokenizers import Tokenizer, models, pre_tokenizers

from quire.llm import queries, viterbi

SF_DIR = "/root/testdata/sf0.001"


def library(scores, by_bytes):
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *scores], unk_id=0, byte_fallback=by_bytes))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=viterbi.MARK, prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text).ids)


@pytest.mark.parametrize("by_bytes", [True, False])
def test_equals_library(by_bytes):
    scores = queries.unigram_scores()
    if not by_bytes:
        scores = [x for x in scores if not x[0].startswith("<0x")]
    count, counter = library(scores, by_bytes), viterbi.Counter(scores)
    rng = random.Random(2)
    alphabets = ["ab", "abcd efgh", "aeé ü1 ", "zß漢字🙂\n ", "▁ a𓀀𓀁", "the and ing "]
    for _ in range(1500):
        alphabet = rng.choice(alphabets)
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 3, 10, 60])))
        assert counter.count(text) == count(text), text


def test_ties_like_library():
    scores = [(viterbi.MARK, -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0)]
    count, counter = library(scores, False), viterbi.Counter(scores)
    rng = random.Random(3)
    for n in range(1, 200):
        text = "".join(rng.choice("aabc") for _ in range(n % 15 + 1))
        assert counter.count(text) == count(text), text


def test_awkward(spark):
    scores = queries.unigram_scores()
    counter = viterbi.Counter(scores)
    df = awkward(spark).selectExpr("*", "'x' AS n_tokens")
    rows = viterbi.count_tokens(df, scores).collect()
    given = sorted((str(r.doc_id), counter.count(r.text)) for r in df.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == given
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert viterbi.count_tokens(df.limit(0), scores).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    count = library(queries.unigram_scores(), True)
    rows = {r.doc_id: r.n_tokens for r in queries.registered()["op6_token_counts"](spark, SF_DIR).collect()}
    assert rows == {i: count(text) for i, text in texts.items()}


def test_two_vocabularies_in_one_worker(spark):
    """Vocabularies that differ in the middle only are told apart."""
    pieces = [(f"{viterbi.MARK}w{i}", -1.0 - i / 1000) for i in range(300)]
    other = [(p.replace("w150", "q150"), s) for p, s in pieces]
    df = spark.createDataFrame([(i, "w150 w3") for i in range(8)], "doc_id long, text string").repartition(2)
    for scores in (pieces, other, pieces):
        want = viterbi.Counter(scores).count("w150 w3")
        assert {r.n_tokens for r in viterbi.count_tokens(df, scores).collect()} == {want}


def test_long_runs_take_little_memory():
    import tracemalloc

    counter = viterbi.Counter([("a", -1.0), ("aa", -1.5), ("ab" * 8, -2.0)])
    word = "ab" * 200_000
    tracemalloc.start()
    assert counter.pieces(word) == 25_000
    assert tracemalloc.get_traced_memory()[1] < 8 * len(word)  # the automaton's own copy of the word
    tracemalloc.stop()
