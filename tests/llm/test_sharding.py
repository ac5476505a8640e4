import hashlib
import random
import zlib

import pytest
from llm_cases import awkward, duck, frame, same

from quire.llm import oracle, queries, sharding

SF_DIR = "/root/testdata/sf0.001"


def size(text):
    return len((text or "").encode()) + 8


def place(key, text):
    return (int(hashlib.md5(text.encode()).hexdigest()[:15], 16) if text is not None else -1, -(2**63) if key is None else key)


def checked(rows, shards):
    """Rows of (key, text, shard, slot): gapless slots, sizes near equal, small records in one range of the order per shard."""
    total = sum(size(text) for _, text, _, _ in rows)
    loads, of = [0] * shards, {}
    for key, text, shard, slot in rows:
        loads[shard] += size(text)
        of.setdefault(shard, []).append((slot, size(text) * shards * sharding.LARGE_PART > total, place(key, text), size(text)))
    ends = None
    for shard in sorted(of):
        mine = sorted(of[shard])
        assert [m[0] for m in mine] == list(range(len(mine)))
        big, small = [m for m in mine if m[1]], [m[2] for m in mine if not m[1]]
        assert mine[: len(big)] == big and [m[3] for m in big] == sorted((m[3] for m in big), reverse=True)
        assert small == sorted(small) and (ends is None or not small or ends <= small[0])
        ends = small[-1] if small else ends
    return loads, total


def found(df, shards):
    texts = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault((r["doc_id"], zlib.crc32((r["text"] or "").encode())), []).append(r["text"])
    out = []
    for r in sharding.assign(df, shards).collect():
        text = texts[r["doc_id"], r["text_crc32"]].pop()
        assert r["size"] == size(text)
        out.append((r["doc_id"], text, r["shard"], r["slot"]))
    assert not any(texts.values())
    return out


@pytest.mark.parametrize("kind", ["even", "copies", "heavy", "short"])
@pytest.mark.parametrize("shards", [1, 7])
def test_laws(spark, monkeypatch, kind, shards):
    monkeypatch.setattr(sharding, "RANGE_RECORDS", 50)
    rng = random.Random(kind)
    texts = {
        "even": ["w" * rng.randint(1, 60) + str(i) for i in range(1500)],
        "copies": ["the same text"] * 700 + [f"text {i}" for i in range(800)],
        "heavy": ["x" * int(1 / (rng.random() + 1e-4)) for _ in range(1200)],
        "short": [rng.choice(["", None, "ü"]) for _ in range(1500)],
    }[kind]
    loads, total = checked(found(frame(spark, texts, "1 AS h"), shards), shards)
    near = max((size(t) for t in texts if size(t) * shards * sharding.LARGE_PART <= total), default=10)
    # A shard is only above the level if one record alone is.
    level = [load for load in loads if load - min(loads) <= 2 * near + shards]
    alone = sum(size(t) > max(level) for t in texts)
    assert len(level) == shards - alone and (kind == "heavy" or not alone)


def test_large_records(spark):
    loads, _ = checked(found(frame(spark, ["a" * 50_000, "b" * 20_000, "c" * 19_000, *["d" * 10] * 2000]), 4), 4)
    assert sorted(loads)[-1] == 50_008 and max(sorted(loads)[:3]) - min(loads) <= 60


def test_splitters_divide(spark, monkeypatch):
    """A range that a poor sample left overfull is divided until it holds twice its share at most."""
    records = sharding.keyed(frame(spark, [str(i % 3) for i in range(4000)]), "doc_id", "text").withColumn("key", sharding._order())
    draw = sharding._drawn
    monkeypatch.setattr(sharding, "_drawn", lambda records, rate, turn: [] if turn == 0 else draw(records, rate, turn))
    total = records.agg({"size": "sum"}).first()[0]
    splitters, sums = sharding.splitters(records, total, 40)
    assert len(splitters) >= 20 and sum(b for b, _ in sums.values()) == total and sum(n for _, n in sums.values()) == 4000
    assert all(b <= 2 * -(-total // 40) + 9 for b, _ in sums.values())


def test_awkward(spark):
    df = awkward(spark)
    rows = found(df, 24)
    checked(rows, 24)
    assert len(rows) == df.count()
    same_ = spark.createDataFrame([(None, None)] * 5 + [(1, "")] * 5, "doc_id long, text string").selectExpr("*", "0 AS record", "1 AS shard", "2 AS key")
    checked(found(same_, 3), 3)
    assert sharding.assign(df.limit(0), 24).collect() == []


def test_written_shards(spark, tmp_path):
    df = frame(spark, [f"text {i}" * (i % 50) for i in range(900)], "'s' AS shard")
    assigned = sharding.write_shards(df, str(tmp_path / "out"), 5, piece=40)
    placed = {(r["shard"], r["slot"]): r["doc_id"] for r in assigned.collect()}
    read = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["shard"], r["slot"]): r["row"]["doc_id"] for r in read.collect()} == placed
    assert {r["row"]["doc_id"]: r["row"] for r in read.collect()} == {r["doc_id"]: r for r in df.collect()}
    assert len(list((tmp_path / "out" / "shard=0").glob("*.parquet"))) >= len([p for p in placed if p[0] == 0]) / 40


def test_query(spark):
    found_ = queries.registered()["op11_sampled_sharding"](spark, SF_DIR)
    same(found_, duck(SF_DIR).execute(oracle.statements()["op11_sampled_sharding"]).df().astype({"grown_shard": object}).replace({float("nan"): None}))
