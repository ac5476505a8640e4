"""Byte-level BPE encoding and decoding with a rank queue made of bitmaps.

A pre-token's bytes form a linked list. Each neighbouring pair that is a merge waits in the
bucket of its rank. Two levels of bitmaps say which buckets hold something, so find-first-set
gives the lowest rank; entries whose pair has changed meanwhile are skipped when they come up.
The cost is near linear in the pre-token, so very long ones are no special case.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import partial
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quire.llm.common import map_text

#: Distinct pre-tokens whose ids a worker remembers; only speed depends on it.
REMEMBERED = 400_000
#: Longer pre-tokens are not remembered.
REMEMBERED_BYTES = 64

#: Texts whose code points are all lower are cut by the quick pattern.
QUICK_BELOW = 0x250

#: Two levels of bitmaps: 2 ** _BITS ranks in a leaf.
_BITS = 8
_MASK = (1 << _BITS) - 1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The rank file's lines: base64 of the token's bytes, then its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: lowest rank first, leftmost among equals."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    after = list(range(1, n + 1))  # a node is named by its first byte; n is the end
    before = list(range(-1, n))
    waits = [get(piece[i : i + 2]) for i in range(n - 1)]  # the rank at which a node's pair waits now
    waits += None, None
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top = 0
    for node, rank in enumerate(waits):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(node)  # ascending, and so a heap already
            else:
                buckets[rank] = [node]
                leaves[rank >> _BITS] = leaves.get(rank >> _BITS, 0) | 1 << (rank & _MASK)
                top |= 1 << (rank >> _BITS)
    while top:
        high = (top & -top).bit_length() - 1
        leaf = leaves[high]
        rank = (high << _BITS) + (leaf & -leaf).bit_length() - 1
        bucket = buckets[rank]
        node = heappop(bucket)
        if not bucket:
            del buckets[rank]
            leaf &= leaf - 1
            leaves[high] = leaf
            if not leaf:
                top &= top - 1
        if waits[node] != rank:
            continue  # stale
        gone = after[node]
        waits[gone] = None
        end = after[node] = after[gone]
        before[end] = node
        # The pairs on both sides of the merged node wait at new ranks, or no longer.
        waits[node] = rank = get(piece[node : after[end]]) if end < n else None
        if rank is not None:
            if rank in buckets:
                heappush(buckets[rank], node)
            else:
                buckets[rank] = [node]
                leaves[rank >> _BITS] = leaves.get(rank >> _BITS, 0) | 1 << (rank & _MASK)
                top |= 1 << (rank >> _BITS)
        left = before[node]
        if left >= 0:
            waits[left] = rank = get(piece[left:end])
            if rank is not None:
                if rank in buckets:
                    heappush(buckets[rank], left)
                else:
                    buckets[rank] = [left]
                    leaves[rank >> _BITS] = leaves.get(rank >> _BITS, 0) | 1 << (rank & _MASK)
                    top |= 1 << (rank >> _BITS)
    ids, node = [], 0
    while node < n:
        end = after[node]
        ids.append(ranks[piece[node:end]])
        node = end
    return ids


def quick_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for the faster `re` module: the same matches on text of code points under ``QUICK_BELOW``.

    Classes of letters, numbers and white space are written out, as the two modules differ in
    them. Only these classes, sets and plain characters may occur in ``pattern``.
    """
    members = {
        name: "".join(re.escape(chr(c)) for c in range(QUICK_BELOW) if regex.match(name, chr(c)))
        for name in (r"\p{L}", r"\p{N}", r"\s")
    }
    parts, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\[sS]|\[\^?|\])", pattern):
        if part == r"\S":
            part = f"[^{members[chr(92) + 's']}]"
        elif part in members:
            part = members[part] if inside else f"[{members[part]}]"
        elif part.startswith("[") or part == "]":
            inside = part != "]"
        parts.append(part)
    return re.compile("".join(parts))


class Encoder(dict):
    """Pre-token to packed ids (little-endian unsigned 32-bit), remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern, self.quick = ranks, regex.compile(pattern), quick_pattern(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = merge(data, self.ranks)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(data) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        pattern = self.quick if not text or max(text) < chr(QUICK_BELOW) else self.pattern
        return b"".join(map(self.__getitem__, pattern.findall(text)))

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))


_SHARED: dict[tuple[int, str], Encoder] = {}


def _shared(data: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept from task to task."""
    key = (zlib.crc32(data), pattern)
    if key not in _SHARED:
        _SHARED[key] = Encoder(read_ranks(data), pattern)
    return _SHARED[key]


def _each(method: str, data, pattern: str):
    work = getattr(_shared(data.value, pattern), method)
    return lambda values: [[work(value) for value in values]]


def encode(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids): the ids of each whole text, packed as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a rank file, read by the driver; every match of ``pattern`` is
    encoded separately, special tokens are ordinary text. A null or empty text has no ids.
    One row per input row, repeated rows included; other columns are left out. Row-local: no
    shuffle; a worker holds one slice of rows and a bounded memory of pre-tokens.
    """
    with open(vocabulary, "rb") as file:
        data = df.sparkSession.sparkContext.broadcast(file.read())
    return map_text(df, partial(_each, "encode", data, pattern), (key, text), "token_ids binary", [pa.binary()])


def decode(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """(key, token_ids, decoded): the bytes that packed ids stand for; null ids give no bytes."""
    with open(vocabulary, "rb") as file:
        data = df.sparkSession.sparkContext.broadcast(file.read())
    columns = df.select(key, ids, df[ids].alias("_ids"))
    return map_text(columns, partial(_each, "decode", data, pattern), (key, ids, "_ids"), "decoded binary", [pa.binary()])


def _both(data, pattern: str):
    encoder = _shared(data.value, pattern)

    def work(texts: list) -> list[list]:
        packed = [encoder.encode(text) for text in texts]
        return [packed, [encoder.decode(ids) for ids in packed]]

    return work


def round_trip(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids, decoded): ``encode`` and then ``decode`` of its ids, in one Python worker a task instead of two."""
    with open(vocabulary, "rb") as file:
        data = df.sparkSession.sparkContext.broadcast(file.read())
    return map_text(df, partial(_both, data, pattern), (key, text), "token_ids binary, decoded binary", [pa.binary()] * 2)
