import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest
from llm_cases import duck, same

from quire.llm import conversations as talk
from quire.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, dropped int, verdict string"


def cheapest(turns):
    """Least (cost, audit) over all edits, by plain recursion over the places of the grammar; turns are (initial, gone, cut)."""
    n = len(turns)

    @cache
    def best(i, place):
        # place 0: nothing yet, 1: after s, 2: after u, 3: after a
        out = [(0, "")] if i == n and place in (0, 3) else []
        steps = {0: "su", 1: "u", 2: "a", 3: "u"}[place]
        if i < n:
            initial, gone, cut = turns[i]
            cost, rest = best(i + 1, place)
            out.append((3 + cost, "D" + rest))
            for letter in steps if not gone else "":
                after = {"s": 1, "u": 2, "a": 3}[letter]
                cost, rest = best(i + 1, after)
                if letter == initial:
                    out.append((cost + cut, "K" + rest))
                elif letter != "s":
                    out.append((cost + 2 + cut, "R" + rest))
        for letter in steps:
            if letter != "s":
                cost, rest = inserted(i, {"u": 2, "a": 3}[letter], 3)
                out.append((cost + 2, "I" + rest))
        return min(out)

    @cache
    def inserted(i, place, left):
        # After an insertion: as best(), with at most ``left`` more insertions in a row.
        out = [(0, "")] if i == n and place == 3 else []
        step = {2: "a", 3: "u"}[place]
        after = {"u": 2, "a": 3}[step]
        if i < n:
            initial, gone, cut = turns[i]
            cost, rest = best(i + 1, place)
            out.append((3 + cost, "D" + rest))
            if not gone:
                cost, rest = best(i + 1, after)
                out.append((cost + cut, "K" + rest) if step == initial else (cost + 2 + cut, "R" + rest))
        if left:
            cost, rest = inserted(i, after, left - 1)
            out.append((cost + 2, "I" + rest))
        return min(out) if out else (10**9, "")

    return best(0, 0)


def plain(rows):
    """The contract, read literally: rows are (conv, turn, role, text)."""
    of, out = {}, []
    for conv, turn, role, text in rows:
        mine = of.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        role, text = "user" if code == 4 else role, "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        mine += [(turn, role, text)] * (2 if code == 3 else 1)
    for conv, mine in of.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, turns, blank, duplicate, truncated = set(), [], 0, 0, 0
        for _, role, text in mine:
            body = text.strip(talk.BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "duplicate"), truncated + (fault == "truncated")
            turns.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        known = [t for t, _, _ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest(tuple(turns))
        length, at, made, given = len(audit.replace("D", "")), 0, [], iter(mine)
        for letter in audit:
            _, role, text = next(given) if letter != "I" else (0, "", "")
            if letter == "D":
                continue
            place, at = at - length % 2, at + 1
            made.append(f"{role if letter == 'K' else 'user' if place % 2 == 0 else 'assistant'}:{text}")
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in talk.repaired_digests(talk.damage(df)).collect()), key=repr)


@pytest.mark.parametrize("segment, band", [(512, 8), (512, 1), (3, 1), (5, 2)])
def test_alignment(monkeypatch, segment, band):
    """Costs and audits against all edits, in one table and in segments."""
    monkeypatch.setattr(talk, "SEGMENT", segment)
    monkeypatch.setattr(talk, "FIRST_BAND", band)
    rng = random.Random(segment + band)
    for _ in range(500):
        weights = rng.choice([(3, 3, 1, 1), (1, 1, 3, 1), (5, 1, 0, 0), (0, 0, 1, 4)])
        turns = [(rng.choices("uasx", weights)[0], rng.random() < rng.choice([0.1, 0.7]), int(rng.random() < 0.3)) for _ in range(rng.randint(0, 16))]
        turns = [(a, gone, 0 if gone else cut) for a, gone, cut in turns]
        kinds = np.array([talk.GONE if gone else "uasx".index(a) for a, gone, _ in turns], np.uint8)
        assert talk.align(kinds, np.array([c for _, _, c in turns], np.int64)) == cheapest(tuple(turns)), turns


def test_bands_leave_cells_out():
    rng = np.random.default_rng(2)
    kinds = np.arange(400) % 2
    kinds[rng.integers(0, 400, 12)] = talk.USER
    cells, build = [], talk.Table.__init__

    def counted(self, *given):
        build(self, *given)
        cells.append(self.rows.size)

    talk.Table.__init__ = counted
    try:
        cost, audit = talk.align(kinds.astype(np.uint8), np.zeros(400, np.int64))
    finally:
        talk.Table.__init__ = build
    assert cost <= 24 and len(audit.replace("I", "")) == 400 and sum(cells) < 400 * 60


def test_brute_force(spark):
    rng = random.Random(4)
    texts = ["Fine.", "cut", " \t\n", "", "Why? ", "No!\x0b", "¿Qué…", None, "Long text. " * 50, " ", "a.\u0085"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "Upper"]
    rows = []
    for conv in [*range(60), None, -5]:
        kind = rng.choice(["plain", "wild"])
        for turn in range(rng.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if kind == "plain" and rng.random() < 0.8 else rng.choice(roles)
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, rng.choice(texts)))
    rows += rows[:9]
    rows += [(77, turn, ("user", "assistant")[turn % 3 % 2], f"{turn}.") for turn in range(90)]
    assert found(spark, rows) == plain(rows)


def test_dropped_and_empty(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    none = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(conv, 0, "user", "Gone.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", none)]
    assert found(spark, []) == []


def test_rows_of_a_repair(spark):
    """The repaired turns come in order and read as the grammar wants."""
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = talk.damage(df)
    out = {}
    for r in talk.repair(rows, talk.judge(rows)).collect():
        turns = out.setdefault(r["conv"], [])
        if r["place"] >= 0:
            assert r["place"] == len(turns)
            turns.append(r["role"][0])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(turns)) for turns in out.values())
    assert set(out) == {r["conv_id"] for r in df.select("conv_id").distinct().collect()}


def test_query(spark):
    frame = queries.registered()["op12_conversation_repair"](spark, SF_DIR)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == plain(rows)
    same(frame, duck(SF_DIR).execute(oracle.statements()["op12_conversation_repair"]).df())
