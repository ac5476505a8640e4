import random
import re

from llm_cases import awkward, duck, frame, same
from pyspark.sql import functions as F

from quire.llm import decontaminate, oracle, queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def compare(spark, docs, items, marks=None):
    found = decontaminate.decontaminate(docs, items)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    wanted = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows == sorted(wanted, key=repr)
    return rows


def test_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = ["Été", "the", "of", "ÀB", "a1", "İx", "und", "x"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 14, 30]))) for i in range(12)] + [(12, None), (13, "..."), (14, "the the the")]
    docs = []
    for _ in range(60):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 1))
            parts += [" ".join(w[a : a + rng.randint(8, 13)]).upper(), text(rng.randint(0, 12))]
        docs.append(" , ".join(parts))
    frame_ = frame(spark, docs, "7 AS n_hit")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = compare(spark, frame_, bench)
    assert any(r[2] for r in rows)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert compare(spark, frame_, bench) == rows
    longer = bench.where("size(split(text, ' ')) >= 10")
    assert any(not r[2] for r in compare(spark, frame_, longer))


def test_short_items_of_a_table(spark):
    """Items of one to nine words beside the given ones, over whole texts; the filter leaves few other runs."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    texts = [w for w in (words(r.text) for r in docs.orderBy("doc_id").limit(40).collect()) if len(w) > 60]
    short = [(10**6 + i, " ".join(w[50 : 51 + i % 9])) for i, w in enumerate(texts)] + [(10**7, "nowhere-else")]
    items = given.select(given.item_id.cast("long"), "text").unionByName(spark.createDataFrame(short, "item_id long, text string"))
    rows = compare(spark, docs, items)
    assert any(str(10**6) in r[3] for r in rows)
    asked = items.select(items.item_id.cast("string").alias("item_id"), decontaminate._hashes("text").alias("words"))
    size = F.size("words")
    windows = decontaminate._windows(asked.where(size > 0), ["item_id"], F.least(size, F.lit(10)))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    passed = decontaminate._short(keyed, ["doc_id", "text_key"], windows)
    exact = passed.join(windows.select("length", "h1", "h2").distinct(), ["length", "h1", "h2"], "left_semi").count()
    runs = 9 * sum(r[1] for r in rows)
    assert exact <= passed.count() <= exact + runs / 1_000


def test_awkward(spark):
    items = spark.createDataFrame([(1, "null id here"), (2, None), (None, "a b")], "item_id long, text string")
    docs = awkward(spark)
    found = decontaminate.decontaminate(docs, items.where("item_id IS NOT NULL"))
    assert found.count() == 9
    assert [r["items"] for r in found.where("doc_id IS NULL").collect()] == [["1"]]
    assert decontaminate.decontaminate(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items).where("doc_id = 6").collect()} == {40_000}


def test_query(spark):
    found = queries.registered()["op7_decontaminate"](spark, SF_DIR)
    same(found, duck(SF_DIR).execute(oracle.statements()["op7_decontaminate"]).df())
