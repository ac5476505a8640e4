"""Sharding by sampled splitters: shards of nearly equal bytes that are ranges of a sort key.

Keys are drawn with a chance by their record's size, quantiles of the draws are the splitters, and
records go to the ranges between them. Ranges that came out overfull are drawn from again and
subdivided. The bytes before each range then give every record its exact place, from which its
shard follows: the sample decides how the work is cut, never which shard a record gets.

A record that is large against a shard cannot be cut, so it is dealt beforehand: the few of that
kind go, largest first, to the emptiest shard, and the ranges fill all shards to one level.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import written

SHARDS = 24
#: Bytes that a record has besides its text.
OVERHEAD = 8
#: A record is large from this part of a shard on; so there are fewer than this many times ``shards`` of them.
LARGE_PART = 256
#: Ranges per shard at least, records a range aims at, and draws per range.
RANGES_PER_SHARD, RANGE_RECORDS, DRAWS = 16, 2_000_000, 16

_LEAST = -(2**63)


@dataclass(frozen=True)
class Levels:
    """What every shard gets: bytes and records of large ones, and where the ranges' bytes are cut."""

    large: list[tuple[int, int, int]]  # (record, shard, slot)
    cuts: list[int]  # bytes of small records in all shards up to each one
    records: list[int]  # large records per shard


def keyed(df: DataFrame, key: str, text: str, record: str | None = None) -> DataFrame:
    """(h, id, record, size, text_crc32): a number of the text, the id, the record's own number, the bytes.

    Equal texts are neighbours in the order of (h, id, record), which no two records share. The
    table is written, so that the numbers stay when a task is repeated.
    """
    number = F.conv(F.substring(F.md5(F.col(text)), 1, 15), 16, 10).cast("bigint")
    rows = df.select(
        F.coalesce(number, F.lit(-1)).alias("h"), F.col(key).alias("id"),
        (F.col(record) if record else F.monotonically_increasing_id()).alias("record"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
    )
    return written(rows, "sharding-keys")


def _order() -> Column:
    return F.struct(F.col("h"), F.coalesce(F.col("id").cast("bigint"), F.lit(_LEAST)).alias("id"), F.col("record"))


def levels(large: list[tuple[int, int]], small: int, shards: int) -> Levels:
    """Deals ``large`` (record, size), in this order, to the emptiest shards; ``small`` bytes level them."""
    heap, dealt, loads, records = [(0, s) for s in range(shards)], [], [0] * shards, [0] * shards
    for record, size in large:
        load, shard = heapq.heappop(heap)
        dealt.append((record, shard, records[shard]))
        records[shard] += 1
        loads[shard] = load + size
        heapq.heappush(heap, (loads[shard], shard))
    # The lowest level up to which the small bytes fill all shards below it.
    below = np.cumsum(sorted(loads)).tolist()
    level = min(-(-(small + total) // n) for n, total in enumerate(below, start=1))
    cuts, sum_ = [], 0
    for load in loads:
        sum_ = min(small, sum_ + max(0, level - load))
        cuts.append(sum_)
    return Levels(dealt, cuts, records)


def _constants(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded to one literal


def _range(splitters: list[tuple[int, int, int]]) -> Column:
    """Number of splitters that are not above the record's key, by bisection."""
    if not splitters:
        return F.lit(0)
    parts = [(_constants(list(column)), F.col("key")[name]) for name, column in zip(("h", "id", "record"), zip(*splitters, strict=True), strict=True)]
    steps = [1 << bit for bit in reversed(range(len(splitters).bit_length()))]

    def not_above(at: Column) -> Column:
        """Whether splitter ``at`` is not above the key: compared part by part, as arrays of structs would not fold."""
        out = F.lit(True)
        for constants, own in reversed(parts):
            value = F.get(constants, at)
            out = (value < own) | ((value == own) & out)
        return out

    def step(at: Column, width: Column) -> Column:
        inside = at + width <= len(splitters)
        return F.when(inside & not_above(at + width - 1), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _drawn(records: DataFrame, rate: Column, turn: int) -> list[tuple]:
    """Keys with the number of times each is drawn: ``rate`` per byte, the fraction decided by a hash."""
    chance = F.pmod(F.xxhash64("h", "id", "record", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(F.col("size") * rate + chance)
    rows = records.withColumn("times", times).where("times > 0").select("key.*", "times").collect()
    return sorted((r["h"], r["id"], r["record"], r["times"]) for r in rows)


def _quantiles(draws: list[tuple], every: int) -> list[tuple[int, int, int]]:
    """The key at which each further ``every`` draws are full."""
    out, held = [], 0
    for *key, times in draws:
        held += times
        if held >= every:
            out.append(tuple(key))
            held = 0
    return out


def splitters(records: DataFrame, total: int, ranges: int) -> tuple[list[tuple], dict[int, tuple[int, int]]]:
    """Splitters, and bytes and records of each range; no range has more than twice its share of bytes.

    ``records`` is (h, id, record, size, key). What comes to the driver is some ``DRAWS`` keys
    per range and one row per range.
    """
    share, turn = max(1, -(-total // ranges)), 0
    found = _quantiles(_drawn(records, F.lit(DRAWS / share), turn), DRAWS)
    while True:
        placed = records.withColumn("range", _range(found))
        sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("most"))
        rows = sums.collect()
        # One record alone cannot be divided, however large.
        overfull = [r["range"] for r in rows if r["bytes"] - r["most"] > 2 * share]
        if not overfull:
            return found, {r["range"]: (r["bytes"], r["n"]) for r in rows}
        turn += 1
        again = placed.where(F.col("range").isin(overfull))
        # More draws each time: in the end every record is drawn, so a range is divided at last.
        draws = _drawn(again, F.lit(DRAWS * 4**turn / share), turn)
        found = sorted({*found, *_quantiles(draws, DRAWS * 2 ** max(0, turn - 1))})


def _first_records(small: DataFrame, found: list[tuple], before: list[int], sums: dict, cuts: list[int]) -> list[int]:
    """For each cut the number of small records whose middle lies before it; only the ranges with a cut are sorted."""
    holding = [max(0, bisect.bisect_right(before, cut) - 1) for cut in cuts]
    counted, n = [0], 0
    for number in range(len(found)):
        n += sums.get(number, (0, 0))[1]
        counted.append(n)
    if not cuts:
        return []
    some = _with_middle(small.withColumn("range", _range(found)).where(F.col("range").isin(sorted(set(holding)))), before)
    each = [F.count(F.when((F.col("range") == r) & (F.col("middle") < 2 * c), 1)).alias(f"c{i}") for i, (r, c) in enumerate(zip(holding, cuts, strict=True))]
    return [counted[r] + n for r, n in zip(holding, some.agg(*each).first(), strict=True)]


def _with_middle(placed: DataFrame, before: list[int]) -> DataFrame:
    """``middle``: twice the place of the record's middle in the bytes of all small ones; ``nth`` in its range."""
    within = Window.partitionBy("range").orderBy("key")
    upto = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("upto", upto).withColumn("nth", F.row_number().over(within))
    return placed.withColumn("middle", 2 * (F.get(_constants(before), F.col("range")) + F.col("upto")) - F.col("size"))


def assign(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", record: str | None = None) -> DataFrame:
    """(key, size, text_crc32, shard, slot, record): the shard of each row of ``df`` and its place there.

    ``size`` is the text's UTF-8 bytes (none for null) and 8 more. All shards have nearly the same
    bytes: they differ by less than a 256th part on either side, unless records larger than a shard
    make that impossible. Rows are ordered by a digest of the text, integer id and their order in
    ``df`` (or the unique long column ``record``), so equal texts are neighbours; a shard has large records
    first, then one range of this order. Null texts come first in it, null ids before others. Repeated
    rows are records of their own. ``slot`` counts from 0 in each shard without gaps. Empty input gives
    no rows; with fewer rows than shards some stay empty. Other columns are not looked at.
    """
    records = keyed(df, key, text, record).withColumn("key", _order())
    total, n = records.agg(F.sum("size"), F.count("*")).first()
    if not n:
        return records.select(F.col("id").alias(key), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"), "record")
    is_large = F.col("size") * (shards * LARGE_PART) > total
    rows = records.where(is_large).select("key.*", "size").collect()
    rows.sort(key=lambda r: (-r["size"], r["h"], r["id"], r["record"]))
    small = records.where(~is_large)
    plan = levels([(r["record"], r["size"]) for r in rows], total - sum(r["size"] for r in rows), shards)

    found, sums = splitters(small, plan.cuts[-1], max(RANGES_PER_SHARD * shards, -(-n // RANGE_RECORDS)))
    before = [0]
    for number in range(len(found)):
        before.append(before[-1] + sums.get(number, (0, 0))[0])
    firsts = [0, *_first_records(small, found, before, sums, plan.cuts[:-1])]
    counted = [0]
    for number in range(len(found)):
        counted.append(counted[-1] + sums.get(number, (0, 0))[1])
    placed = _with_middle(small.withColumn("range", _range(found)), before)
    shard = F.size(F.filter(_constants([2 * c for c in plan.cuts[:-1]]), lambda cut: cut <= F.col("middle"))) if shards > 1 else F.lit(0)
    slot = F.get(_constants(counted), F.col("range")) + F.col("nth") - 1 + F.get(_constants([n - f for n, f in zip(plan.records, firsts, strict=True)]), F.col("shard"))
    out = placed.withColumn("shard", shard).withColumn("slot", slot).select("id", "size", "text_crc32", "shard", "slot", "record")
    if plan.large:
        numbers, to, place = map(list, zip(*plan.large, strict=True))
        dealt = F.map_from_arrays(_constants(numbers), F.arrays_zip(_constants(to).alias("shard"), _constants(place).alias("slot")))
        own = records.where(is_large).withColumn("to", F.try_element_at(dealt, F.col("record")))
        out = out.unionByName(own.select("id", "size", "text_crc32", F.col("to.shard").cast("int").alias("shard"), F.col("to.slot").alias("slot"), "record"))
    return out.withColumnRenamed("id", key)


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", text: str = "text", piece: int = 100_000) -> DataFrame:
    """Writes ``df`` as Parquet in folders ``shard=N`` of (slot, row), files in the order of slots; what ``assign`` gave.

    A file holds ``piece`` records at most, so that a shard is the work of many tasks.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("record"))
    rows = written(rows, "sharding-rows")
    bare = rows.select(F.col(f"row.`{key}`").alias(key), F.col(f"row.`{text}`").alias(text), F.col("record").alias("_record"))
    assigned = written(assign(bare, shards, key, text, "_record"), "sharding-places")
    placed = rows.join(assigned.select("record", "shard", "slot"), "record")
    ordered = placed.withColumn("piece", F.floor(F.col("slot") / piece)).repartition("shard", "piece").sortWithinPartitions("shard", "slot")
    ordered.select("slot", "row", "shard").write.option("maxRecordsPerFile", piece).partitionBy("shard").parquet(path)
    return assigned
