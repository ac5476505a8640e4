"""Near-duplicate classes by MinHash signatures and an inverted join on their coordinates.

Every distinct set of word shingles is posted under its pairs of coordinate and value. Two sets
that are similar enough agree in ``matches`` coordinates at least (but for a chance under one in
10^8), so they share one of the ``COORDINATES`` less matches plus 1 rarest pairs of either: only this
prefix is posted, the frequent rest is skipped. The sets of one posting list are compared by their
signatures: collisions are counted, pairs below the match threshold are dropped, and pairs that are
merged already are skipped. Pairs above the threshold hang together as families; only the texts of
families are read again, to confirm links on full sets. Links then make the classes.

Exact copies of a set are one node throughout, found in salted parts. A long list or a large family
is cut into blocks by hash, one group for each pair of blocks, and a group gives only pairs that
connect something new.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import blank_words, grams, long_lists, map_text, mixed, word_hashes, written
from quire.llm.components import components

SHINGLE = 5
#: Similarity in hundredths, unless given: links have 100 * intersection >= percent * union.
PERCENT = 85
COORDINATES = 64
#: Chance under which sets of just that similarity may agree in too few coordinates.
MISSED = 1e-8
#: Sets of a block of a posting list (some 150 bytes each).
LIST_ROWS = 4_000
#: Parts in which copies of one set are brought together.
SALTS = 64
#: Sets and bytes of text of a block of a family.
BLOCK_ROWS = 1_000
BLOCK_BYTES = 8_000_000
#: Members of families that are broadcast to the texts (some 40 bytes each); with more of them texts are shuffled.
BROADCAST_ROWS = 500_000

_rng = np.random.default_rng(20_25)
_FACTORS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def matches(percent: int) -> int:
    """Coordinates in which sets of that similarity agree at least, but for a chance under ``MISSED``."""
    same, chance = percent / 100, 0.0
    for n in range(COORDINATES + 1):
        chance += math.comb(COORDINATES, n) * same**n * (1 - same) ** (COORDINATES - n)
        if chance >= MISSED:
            return n
    return COORDINATES


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    hashes, lengths = word_hashes([blank_words(text) for text in texts])
    values, count = grams(hashes, lengths, SHINGLE)
    ends, words = np.cumsum(count), np.cumsum(lengths)
    sets = [np.unique(values[end - n : end]) for end, n in zip(ends, count, strict=True)]
    for i in np.flatnonzero((count == 0) & (lengths > 0)):  # fewer words than a shingle: all of them are one
        n = int(lengths[i])
        sets[i] = grams(hashes[words[i] - n : words[i]], np.array([n]), n)[0]
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES): smallest value of each hash function; 0 for an empty set."""
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    for i, values in enumerate(sets):
        for at in range(0, len(values), 4_096):
            least = (values[at : at + 4_096, None] * _FACTORS + _SHIFTS).min(axis=0) >> np.uint64(32)
            out[i] = least if at == 0 else np.minimum(out[i], least)
    return out


def _sketch(texts: list[str | None]) -> list:
    sets = shingles(texts)
    count = np.fromiter(map(len, sets), np.int64, len(sets))
    whole = [int(mixed(s).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None for s in sets]
    second = [int(mixed(s * _FACTORS[0] + _SHIFTS[0]).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None for s in sets]
    tokens = mixed(signatures(sets).astype(np.uint64) << np.uint64(8) | np.arange(COORDINATES, dtype=np.uint64))
    brief = [row.tobytes() for row in tokens.astype(np.uint16)]
    return [count, whole, second, long_lists(tokens.ravel(), np.full(len(sets), COORDINATES)), brief]


def _prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(id, token): postings of each node under its rarest coordinate-value pairs that another node has too."""
    every = nodes.select("id", F.explode("tokens").alias("token"))
    shared = every.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    have = every.join(shared, "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    # Pairs that no other node has come first in the order by frequency.
    rarest = F.slice("t", F.lit(1), F.greatest(F.lit(0), F.size("t") - (matches(percent) - 1)))
    return have.select("id", F.explode(rarest).alias("t")).select("id", "t.token")


def _listed(nodes: DataFrame, percent: int) -> DataFrame:
    """Members of posting lists with their signatures, once for each pair of blocks they are in."""
    posted = written(_prefixes(nodes, percent), "neardup-postings")
    size = posted.groupBy("token").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    rows = _block_pairs(posted.join(size, "token"))
    return rows.select("token", "low", "high", "block", "id").join(nodes.select("id", "n_shingles", "brief"), "id")


def _block_pairs(members: DataFrame) -> DataFrame:
    """``members`` with block, low and high: once for each pair that their block out of ``blocks`` is in."""
    of = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    of = of.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return of.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})


def collisions(signs: np.ndarray, sizes: np.ndarray, side: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of rows that agree in ``matches`` coordinates, enough to connect whatever such pairs connect.

    ``side`` is as for ``links``; pairs whose sizes alone forbid the similarity are none.
    """
    least, two, top = matches(percent), bool(side.any()), np.arange(len(signs))
    for i in range(len(signs) - 1):
        apart = top[i + 1 :] != top[i]
        if two:
            apart &= side[i + 1 :] != side[i]
        rest = np.flatnonzero(apart) + i + 1
        rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
        for j in rest[np.count_nonzero(signs[rest] == signs[i], axis=1) >= least]:
            if top[j] != top[i]:
                top[top == top[j]] = top[i]
                yield i, int(j)


def _counted(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts collisions within each (token, low, high) of rows in that order; a group may span batches."""

    def pairs(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        keys = np.stack([rows.column(name).to_numpy() for name in ("token", "low", "high")])
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        ends = np.append(starts[1:], rows.num_rows)
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        ids, sizes = rows.column("id").to_numpy(), rows.column("n_shingles").to_numpy()
        side = (rows.column("block").to_numpy() != keys[1]).astype(np.int64)
        signs = np.frombuffer(b"".join(rows.column("brief").to_pylist()), np.uint16).reshape(-1, COORDINATES)
        found = [
            (ids[at + i], ids[at + j])
            for at, end in zip(starts, ends, strict=True)
            for i, j in collisions(signs[at:end], sizes[at:end], side[at:end], percent)
        ]
        a, b = (np.array([pair[k] for pair in found], np.int64) for k in (0, 1))
        done = int(ends[-1]) if len(ends) else 0
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]), rows.slice(done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None and held.num_rows:
                rows = pa.concat_tables([held, rows])
            if rows.num_rows:
                found, held = pairs(rows, False)
                yield found
        if held is not None and held.num_rows:
            yield pairs(held, True)[0]

    return run


def _families(nodes: DataFrame, percent: int) -> DataFrame:
    """(id, component): nodes that hang together by pairs above the match threshold."""
    group = ["token", "low", "high"]
    rows = _listed(nodes, percent).repartition(*group).sortWithinPartitions(*group)
    return components(rows.mapInArrow(_counted(percent), "a bigint, b bigint"), "neardup-families")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def links(sets: list[np.ndarray], side: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Confirmed links between the sets, enough to connect whatever links connect.

    ``side`` is 0 for all sets of one block; of two blocks only pairs of different sides count.
    """
    n = len(sets)
    signs, least = signatures(sets), matches(percent)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.zeros(0, np.int64)
    parts = np.split(codes, np.cumsum(sizes)[:-1])
    marked = np.zeros(codes.max(initial=0) + 1, bool)
    forest = _Forest(n)
    two = bool(side.any())
    # The sets that agree with most others come first: they connect a family at once.
    common = np.zeros(n, np.int64)
    for c in range(COORDINATES):
        _, back, number = np.unique(signs[:, c], return_inverse=True, return_counts=True)
        common += number[back]
    order = np.argsort(-common, kind="stable")
    for place, i in enumerate(order):
        later = order[place + 1 :]
        near = (100 * np.minimum(sizes[later], sizes[i]) >= percent * np.maximum(sizes[later], sizes[i]))
        if two:
            near &= side[later] != side[i]
        later = later[near]
        later = later[np.count_nonzero(signs[later] == signs[i], axis=1) >= least]
        mine = forest.top(int(i))
        later = [int(j) for j in later if forest.top(int(j)) != mine]
        if not later:
            continue
        marked[parts[i]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[later])[:-1]])
        both = np.add.reduceat(marked[np.concatenate([parts[j] for j in later])].astype(np.int64), starts)
        marked[parts[i]] = False
        for j in np.array(later)[100 * both >= percent * (sizes[later] + sizes[i] - both)]:
            if forest.join(int(i), int(j)):
                yield int(i), int(j)


def _within(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def linked(family: pd.DataFrame) -> pd.DataFrame:
        family = family.drop_duplicates("id")
        side = (family["block"] != family["low"]).to_numpy().astype(np.int64)
        ids = family["id"].to_numpy()
        found = [(ids[i], ids[j]) for i, j in links(shingles(list(family["text"])), side, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return linked


def _placed(members: DataFrame) -> DataFrame:
    """(id, text_key, component, block, low, high): each member of a family once for each pair of blocks it is in."""
    size = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    of = _block_pairs(members.join(size.select("component", blocks.alias("blocks")), "component"))
    return of.select("id", "text_key", "component", "block", "low", "high")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, text_key, n_shingles, component_id, kept): one row per row of ``df``.

    A text's set holds its distinct runs of ``SHINGLE`` words (all words at once, if fewer); words
    are runs of other than ASCII white space, A-Z in lower case. Rows are linked whose sets have
    100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id reachable, and
    ``kept`` says that the row has it. A text without words has an empty set and no links. Rows with
    one id are one node, all kept or none; of several texts of an id the one with the smallest
    hash is compared. A row without an id is linked with nothing and kept.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    schema = "n_shingles bigint, h1 bigint, h2 bigint, tokens array<bigint>, brief binary"
    types = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]
    sized = rows.select("id", "text_key", F.octet_length("text").alias("bytes"), "text")
    sketched = written(map_text(sized, lambda: _sketch, ("id", "text_key", "bytes", "text"), schema, types), "neardup-sketches")
    whole = ["n_shingles", "h1", "h2"]
    usable = sketched.where("id IS NOT NULL AND n_shingles > 0")
    one = usable.groupBy("id").agg(F.min(F.struct("text_key", *whole, "bytes")).alias("s")).select("id", "s.*")
    one = one.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    parts = one.groupBy(*whole, "salt").agg(F.min(F.struct("id", "text_key", "bytes")).alias("s"))
    heads = written(parts.groupBy(*whole).agg(F.min("s").alias("s")).select(*whole, "s.*"), "neardup-heads")
    nodes = sketched.join(heads.select("id", "text_key"), ["id", "text_key"]).dropDuplicates(["id"]).select("id", "n_shingles", "tokens", "brief")
    family = _families(nodes, percent)
    placed = written(_placed(heads.select("id", "text_key", "bytes").join(family, "id")), "neardup-blocks")
    if placed.count() <= BROADCAST_ROWS:
        placed = F.broadcast(placed)
    found = rows.join(placed, ["id", "text_key"]).groupBy("component", "low", "high").applyInPandas(_within(percent), "a long, b long")
    linked = components(found, "neardup-links")
    of = heads.join(linked, "id", "left").select(*whole, F.coalesce("component", "id").alias("component"))
    joined = one.join(parts.join(of, whole).select(*whole, "salt", "component"), [*whole, "salt"]).select("id", "component")
    out = sketched.select("id", "text_key", "n_shingles").join(joined, "id", "left")
    component = F.coalesce("component", "id")
    kept = F.coalesce(component == F.col("id"), F.lit(True))
    return out.select(F.col("id").alias(key), "text_key", "n_shingles", component.alias("component_id"), kept.alias("kept"))
