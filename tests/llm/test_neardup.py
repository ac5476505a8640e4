import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, duck, frame, same

from quire.llm import components, neardup, oracle, queries

SF_DIR = "/root/testdata/sf0.001"


def plain_sets(texts):
    out = []
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        n = min(5, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def plain(rows, percent=85):
    """component by brute force over all pairs, of (id, text) rows with different ids."""
    sets = plain_sets([text for _, text in rows])
    up = {i: i for i, _ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(rows[a][0]), top(rows[b][0])
                up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i), top(i) == i) for (i, _), s in zip(rows, sets, strict=True)}


def family_texts(seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = ["", None, " \x0b ", "one two", "ONE two", "one\x1ftwo", "Äb c", "äb c"]
    for _ in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy) if rng.random() < 0.7 else "\n".join(copy).upper())
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(25)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [neardup.BLOCK_ROWS, 8])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    monkeypatch.setattr(neardup, "LIST_ROWS", block)
    texts = family_texts()
    found = neardup.near_duplicates(frame(spark, texts, "0 AS component_id"))
    rows = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert rows == plain(list(enumerate(texts)))
    assert len({c for _, c, _ in rows.values()}) < len(rows) - 10


def test_links_in_memory():
    texts = family_texts(11)
    sets = neardup.shingles(texts)
    assert [len(s) for s in sets] == [len(s) for s in plain_sets(texts)]
    some = [s for s in sets if len(s)]
    rows = [(i, t) for i, t in enumerate(texts) if len(sets[i])]
    up = list(range(len(some)))
    for a, b in neardup.links(some, np.zeros(len(some), np.int64)):
        x, y = min(up[a], up[b]), max(up[a], up[b])
        up = [x if u == y else u for u in up]
    expected = plain(rows)
    numbers = {i: at for at, (i, _) in enumerate(rows)}
    assert up == [numbers[expected[i][1]] for i, _ in rows]


def test_collisions():
    texts = [t for t in family_texts(13) if t and t.split()]
    sets = neardup.shingles(texts)
    signs, sizes = neardup.signatures(sets), np.array([len(s) for s in sets])
    near = (signs[:, None] == signs[None]).sum(axis=2) >= neardup.matches(85)
    near &= 100 * np.minimum(sizes[:, None], sizes) >= 85 * np.maximum(sizes[:, None], sizes)
    for side in (np.zeros(len(sets), np.int64), np.arange(len(sets)) % 2):
        expected = near & (side[:, None] != side) if side.any() else near
        top = np.arange(len(sets))
        for a, b in neardup.collisions(signs, sizes, side):
            assert expected[a, b] and top[a] != top[b]  # nothing that is merged already
            top[top == top[b]] = top[a]
        assert all(top[a] == top[b] for a, b in zip(*np.nonzero(expected), strict=True))


def test_groups_span_batches():
    texts = [t for t in family_texts(17) if t and t.split()]
    sets = neardup.shingles(texts)
    brief = [row.astype(np.uint16).tobytes() for row in neardup.signatures(sets)]
    n = len(sets)
    rows = pa.table({
        "id": range(n), "token": [i // 40 for i in range(n)], "low": [0] * n, "high": [0] * n, "block": [0] * n,
        "n_shingles": [len(s) for s in sets], "brief": brief,
    })
    whole, cut = ([p for b in neardup._counted(85)(iter(rows.to_batches(size))) for p in b.to_pylist()] for size in (n, 7))
    assert whole and whole == cut


def test_template_makes_no_family(spark, monkeypatch):
    """Texts that share a third of their words have common postings, but hang together nowhere."""
    rng = random.Random(3)
    own = lambda n: " ".join(f"o{rng.randrange(10**9)}" for _ in range(n))
    template = " ".join(f"t{i}" for i in range(55))
    texts = [f"{template} {own(45)}" for _ in range(400)] + [own(60)] * 2
    seen = []
    families = neardup._families
    monkeypatch.setattr(neardup, "_families", lambda nodes, percent: seen.append(families(nodes, percent)) or seen[-1])
    found = neardup.near_duplicates(frame(spark, texts)).collect()
    assert seen[0].count() <= 40
    assert sum(r.kept for r in found) == 401 and [r.component_id for r in found if not r.kept] == [400]


def test_hot_copies(spark):
    texts = ["one and the same text of nine words here"] * 700 + ["some other text of eight words over here"] * 3
    found = neardup.near_duplicates(frame(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 0 if i < 700 else 700 for i in range(703)}


def test_awkward(spark):
    found = neardup.near_duplicates(awkward(spark)).collect()
    assert len(found) == 9 and all(r.kept for r in found)
    assert all(r.component_id == r.doc_id for r in found)
    assert {r.n_shingles for r in found if r.doc_id == 6} == {2}
    assert neardup.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(200, 260)]
    rng.shuffle(chain)
    edges = [*chain, (5, 5), (1, 9), (9, 1), (3, 9), *[(1000, 1000 + i) for i in range(1, 50)]]
    found = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    expected = {i: 200 for i in range(200, 261)} | {1: 1, 9: 1, 3: 1} | {i: 1000 for i in range(1000, 1050)}
    assert found == expected
    assert components.components(spark.createDataFrame([(5, 5)], "a long, b long"), "test").count() == 0


def test_query(spark):
    found = queries.registered()["op5_near_duplicates"](spark, SF_DIR)
    same(found, duck(SF_DIR).execute(oracle.statements()["op5_near_duplicates"]).df())


def test_matches():
    assert neardup.matches(85) == 36 and neardup.matches(80) == 31
    assert neardup.matches(100) == 64 and neardup.matches(1) == 0
