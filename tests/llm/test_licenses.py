import random
import re

from llm_cases import awkward, frame

from quire.llm import licenses, queries

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text):
    w, places, labels = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(rows, texts):
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, texts))
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert not r.base_labels or r.score == 1.0


def test_phrases_by_brute_force(spark):
    rng = random.Random(6)
    parts = "cc by CC-BY, all rights reserved general public license the rights All all cc cc by by".split(" ")
    texts = dict(enumerate([" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, ""]))
    check(licenses.scan(frame(spark, list(texts.values()), "1 AS n_base")).collect(), texts)


def test_notices(spark):
    mit, apache = licenses.NOTICES["mit"], licenses.NOTICES["apache-2.0"]
    changed = mit.split()
    changed[9:9] = ["very", "kindly"]
    del changed[20]
    texts = [f"some text before. {mit} and after", " ".join(changed).upper(), apache.lower(), " ".join(mit.split()[:8]), "of this software and", "x"]
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert rows[0].labels == "mit" and rows[0].score == 1.0
    assert rows[1].labels == "mit" and licenses.COVER <= rows[1].score < 1
    assert "apache-2.0" in rows[2].labels
    assert [rows[i].labels for i in (3, 4, 5)] == ["", "", ""]


def test_awkward(spark):
    df = awkward(spark).selectExpr("*", "'x' AS labels")
    rows = licenses.scan(df).collect()
    assert len(rows) == 9 and {(r.n_base, r.labels, r.score) for r in rows} == {(0, "", 0.0)}
    twice = spark.createDataFrame([(1, "all rights reserved")] * 2 + [(None, "cc by cc by")] * 2, "doc_id long, text string")
    assert sorted(r.n_base for r in licenses.scan(twice).collect()) == [1, 1, 2, 2]
    assert licenses.scan(df.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.registered()["op9_license_scan"](spark, SF_DIR).collect()
    check(rows, texts)
    for r in rows:
        whole = " ".join(words(texts[r.doc_id]))
        assert ("apache-2.0-short" in r.labels) == ("licensed under the apache license version 2 0" in whole)
