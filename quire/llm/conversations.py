"""Conversation structure repair: Wagner-Fischer alignment of turns with the strings of the role grammar.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles. Its turns are aligned with
every feasible length of that alternating string by a table of edit costs. All lengths share one
table, as it is filled from the end: the string that is still to come depends only on its length.
Cells that no alignment of the incumbent's cost can pass are left out (Ukkonen's bands); a band
starts narrow and widens until the cheapest alignment that was found fits in it. The audits of all
cheapest alignments are traced back and the least one is taken.

A long conversation is aligned in segments from its last to its first one. What a segment has to
know of the later ones is, for each state of the string at its end, the least cost and audit.

Spark orders the rows of each conversation in a partition; a task streams through them. The
first pass carries roles and digests and gives one verdict per conversation, the second one brings
the verdict to the rows and applies it, one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SLICE_ROWS, slices

# The costs of edits, and what a truncated turn costs unless it is deleted.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

BLANKS = " \t\n\x0b\x0c\r"
#: Turns that one table holds; a longer conversation is cut into segments.
SEGMENT = 512
#: Cost that the first band allows.
FIRST_BAND = 8

USER, ASSISTANT, SYSTEM, OTHER, GONE = range(5)
# What is still to come of the target at a place: nothing, an odd or even rest, or all of one that starts with s.
NOTHING, ODD, EVEN, START = "nothing", "odd", "even", "start"

_FAR = 1 << 40

VERDICT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


class Table:
    """Costs of aligning the turns from ``i`` on with the last ``r`` letters of a string, within a band.

    ``odd`` says that an odd number of letters follows these. Cell (i, r) lies at column
    r - (turns left) + ``low``; alignments of cost ``band`` or less stay within.
    """

    def __init__(self, kinds: np.ndarray, cut: np.ndarray, odd: int, band: int):
        n, self.low, high = len(kinds), band // DELETE, band // INSERT
        columns = np.arange(self.low + high + 1)
        self.kinds, self.odd, self.band, self.n = kinds, odd, band, n
        self.rows = rows = np.full((n + 1, len(columns) + 1), _FAR, np.int64)
        rest = columns - self.low
        rows[n, :-1] = np.where(rest >= 0, INSERT * rest, _FAR)
        slope = INSERT * columns
        for i in range(n - 1, -1, -1):
            rest = n - i + columns - self.low
            kind, later = kinds[i], rows[i + 1]
            cheapest = later[1:] + DELETE
            if kind != GONE:
                user, assistant = (0 if kind == USER else REROLE) + cut[i], (0 if kind == ASSISTANT else REROLE) + cut[i]
                kept = later[:-1] + np.where((rest + odd) & 1, assistant, user)
                kept[rest < 1] = _FAR
                cheapest = np.minimum(cheapest, kept)
            cheapest[rest < 0] = _FAR
            found = np.minimum.accumulate(cheapest - slope) + slope
            rows[i, :-1] = np.where((rest >= 0) & (found < _FAR // 2), found, _FAR)

    def cost(self, i: int, r: int) -> int:
        column = r - (self.n - i) + self.low
        return int(self.rows[i, column]) if 0 <= column < self.rows.shape[1] - 1 and r >= 0 else _FAR

    def lengths(self, i: int) -> Iterator[tuple[int, int]]:
        """(length, cost) of what the turns from ``i`` on can be aligned with."""
        row = self.rows[i]
        for column in np.flatnonzero(row < _FAR):
            yield int(column) + self.n - i - self.low, int(row[column])

    def audit(self, i: int, r: int) -> str:
        """The least of the cheapest audits of a cell: in each cell the first letter that keeps to its cost."""
        out = []
        while i < self.n or r:
            here = self.cost(i, r)
            if i < self.n and self.cost(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r and self.cost(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.kinds[i] == (ASSISTANT if (r + self.odd) & 1 else USER) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _least(candidates: list[tuple]) -> tuple | None:
    """(cost, audit): cheapest, then least audit; each candidate is (cost, function that traces the audit)."""
    if not candidates:
        return None
    cost = min(c for c, _ in candidates)
    return cost, min(trace() for c, trace in candidates if c == cost)


def _segment(kinds: np.ndarray, cut: np.ndarray, after: dict, first: bool) -> dict:
    """The least (cost, audit) for each state before the segment, from those after it."""
    n, band = len(kinds), FIRST_BAND
    ends = {state: after[state] for state in (NOTHING, ODD, EVEN) if after[state]}
    cheapest_end = min(cost for cost, _ in ends.values())
    while True:
        tables = {odd: Table(kinds, cut, odd, band) for odd in {int(state == ODD) for state in ends}}
        found = {ODD: [], EVEN: []}

        def reached(i: int, wanted: str, prefix: str, spent: int) -> list[tuple]:
            out = []
            for state, (cost, audit) in ends.items():
                table = tables[int(state == ODD)]
                for r, more in table.lengths(i):
                    before = state if not r else ODD if (r + table.odd) & 1 else EVEN
                    if before == wanted:
                        out.append((spent + cost + more, lambda t=table, r=r, a=audit: prefix + t.audit(i, r) + a))
            return out

        for state in found:
            found[state] = reached(0, state, "", 0)
        need = [EVEN] if first else [EVEN, ODD]
        # Real alignments all, so the cheapest one bounds the least cost: within its band nothing is missed.
        incumbents = [min((c for c, _ in found[s]), default=_FAR) - cheapest_end for s in need]
        if max(incumbents) <= band:
            break
        band = min(2 * band, max(incumbents)) if max(incumbents) < _FAR // 2 else 2 * band
    starts = []
    for i in np.flatnonzero(kinds == SYSTEM):
        starts += reached(int(i) + 1, EVEN, "D" * int(i) + "K", DELETE * int(i) + int(cut[i]))
    if after[START]:
        cost, audit = after[START]
        starts.append((DELETE * n + cost, lambda a=audit: "D" * n + a))
    cost, audit = after[NOTHING]
    return {NOTHING: (DELETE * n + cost, "D" * n + audit), ODD: _least([] if first else found[ODD]), EVEN: _least(found[EVEN]), START: _least(starts)}


def align(kinds: np.ndarray, cut: np.ndarray) -> tuple[int, str]:
    """Least cost and the ASCII-least of the audits that have it; ``cut`` is what each turn costs if it stays."""
    states = {NOTHING: (0, ""), ODD: None, EVEN: None, START: None}
    for at in reversed(range(0, len(kinds), SEGMENT)):
        states = _segment(kinds[at : at + SEGMENT], cut[at : at + SEGMENT], states, at == 0)
    return min(states[state] for state in (NOTHING, EVEN, START) if states[state])


class _Faults:
    """What the first pass gathers of one conversation while its rows go by."""

    def __init__(self):
        self.least = self.most = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.kinds, self.cut, self.seen, self.initial = bytearray(), bytearray(), set(), None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, truncated: bool) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.least, self.most, self.last = turn if self.least is None else self.least, turn, turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        again = (role, digest) in self.seen
        self.seen.add((role, digest))
        self.blank += blank
        self.duplicate += again and not blank
        gone = blank or again
        self.truncated += truncated and not gone
        self.kinds.append(GONE if gone else {"u": USER, "a": ASSISTANT, "s": SYSTEM}.get(role[:1], OTHER))
        self.cut.append(TRUNCATED if truncated and not gone else 0)

    def verdict(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        cost, audit = align(np.frombuffer(self.kinds, np.uint8), np.frombuffer(self.cut, np.uint8).astype(np.int64))
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, dropped): the rows after faults that the checksum of ``conv:turn`` picks, nulls as one space.

    0 drops a row (it stays, marked ``dropped``, so that its conversation is known), 1 empties its
    text, 2 takes its sentence ends out, 3 repeats it, 4 makes it the user's.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said(conv), F.lit(":"), said(turn))) % 20
    body = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said(text), "[.!?]", "")).otherwise(said(text))
    return df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(said(role)).alias("role"), body.alias("text"), (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """The rows of a conversation together, by turn (nulls first), role and digest."""
    return rows.repartition("conv").sortWithinPartitions("conv", *first, F.asc_nulls_first("turn"), "role", "digest")


def judge(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit): one row per conversation of ``rows``.

    ``rows`` is (conv, turn, role, text, dropped) as ``damage`` gives it. Of equal turns the order is
    that of role and of the text's digest, so repeated rows are neighbours. A null conversation is
    one of its own; null turns come first and count for no gap. A conversation whose rows are all
    dropped has zeros and an empty audit. Empty input gives no rows. A conversation is one task's
    work, in which a turn takes about 200 bytes; its text does not come along.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = rows.select(
        "conv", "turn", "role", F.unhex(F.md5("text")).alias("digest"), (F.length(bare) == 0).alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"), "dropped",
    )
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", *[part.strip().split(" ")[0] for part in VERDICT.split(",")]]
        current, faults, out, types = None, None, [], None

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], types), *[pa.array(c, pa.int64()) for c in columns[1:-1]], pa.array(columns[-1], pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for given in batches:
            types = given.schema.field(0).type
            columns = [c.to_pylist() for c in given.columns]
            for conv, turn, role, digest, blank, truncated, dropped in zip(*columns, strict=True):
                if faults is None or conv != current:
                    if faults is not None:
                        out.append((current, *faults.verdict()))
                        if len(out) >= SLICE_ROWS:
                            yield batch()
                    current, faults = conv, _Faults()
                if not dropped:
                    faults.add(turn, role, digest, blank, truncated)
        if faults is not None:
            out.append((current, *faults.verdict()))
            yield batch()

    return _ordered(facts).mapInArrow(run, f"conv {kind}, {VERDICT}")


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that an audit makes of the given ones."""
    length, at = len(audit) - audit.count("D"), 0
    lead = length & 1
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if (at - lead) & 1 else "user"
        at += 1
        yield role, text


def repair(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(conv, verdict, place, role, text): the repaired turns in order from place 0, each conversation after its verdict.

    The verdict's row has place -1 and no role or text; turns have no verdict. The rows of a
    conversation are together and in order within a partition. Texts stream through one at a time.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    struct = f"struct<{VERDICT.replace(' ', ':').replace(',:', ',')}>"
    names = [part.strip().split(" ")[0] for part in VERDICT.split(",")]
    heads = verdicts.select("conv", F.struct(*names).alias("verdict"), F.lit(0).alias("part"))
    turns = rows.where("NOT dropped").select("conv", F.lit(1).alias("part"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    both = heads.unionByName(turns, allowMissingColumns=True).select("conv", "verdict", "part", "turn", "role", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def given() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                fields = [batch.schema.field(i) for i in (0, 1)]
                schema = pa.schema([*fields, ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
                for part in slices(batch, 6):
                    columns = [part.column(i).to_pylist() for i in (0, 1, 4, 6)]
                    yield from zip(*columns, strict=True)

        source, head = given(), None

        def turns_of_one() -> Iterator[tuple[str, str]]:
            nonlocal head
            for conv, verdict, role, text in source:
                if verdict is not None:
                    head = conv, verdict
                    return
                yield role, text

        def made() -> Iterator[tuple]:
            nonlocal head
            for _ in turns_of_one():
                raise ValueError("a conversation has no verdict")
            while head is not None:
                (conv, verdict), head = head, None
                yield conv, verdict, -1, None, None
                rest = turns_of_one()
                for place, (role, text) in enumerate(_edited(verdict["audit"] or "", rest)):
                    yield conv, None, place, role, text
                for _ in rest:
                    raise ValueError("an audit is shorter than its conversation")

        out, size = [], 0
        for row in made():
            out.append(row)
            size += len(row[4] or "")
            if len(out) >= SLICE_ROWS or size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return _ordered(both, "part").mapInArrow(run, f"conv {kind}, verdict {struct}, place bigint, role string, text string")


def digests(repaired: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, the verdict's columns, repaired_sha256): ``repaired`` as ``repair`` gives it, read once in its order."""
    kind = repaired.schema["conv"].dataType.simpleString()
    names = [part.strip().split(" ")[0] for part in VERDICT.split(",")]
    struct = repaired.schema["verdict"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = verdict = digest = None
        for batch in batches:
            out = []
            for key_, head, place, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if head is not None:
                    if verdict is not None:
                        out.append((conv, verdict, digest.hexdigest()))
                    conv, verdict, digest = key_, head, hashlib.sha256()
                else:
                    digest.update(("\n" * (place > 0) + f"{role}:{text}").encode())
            fields = [batch.schema.field(0).type, batch.schema.field(1).type, pa.string()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), fields, strict=True)], ["conv", "verdict", "sha"])
        if verdict is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((conv, verdict, digest.hexdigest()), fields, strict=True)], ["conv", "verdict", "sha"])

    out = repaired.mapInArrow(run, f"conv {kind}, verdict {struct}, sha string")
    return out.select(F.col("conv").alias(key), *[f"verdict.{n}" for n in names], F.col("sha").alias("repaired_sha256"))


def repaired_digests(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Verdicts of all conversations of ``rows`` with the digest of what their audits make of them."""
    return digests(repair(rows, judge(rows)), key)
