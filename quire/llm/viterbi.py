"""Token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic
programming carries, per character, only the best score and the number of pieces of that best
path. Ties go to the path whose last piece starts first, as in the `tokenizers` library, which
walks starts from left to right and replaces a path only by a strictly better one. A character
that no piece covers alone costs the lowest score less 10 and counts as its bytes where the
vocabulary has byte pieces, else once per run of such characters.

Text is cut before every space, as in that library's Metaspace step: a mark stands for each
space and is put before the text if it lacks one. Pieces never cross the cut, so the counts of
distinct words can be remembered.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import map_text

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
REMEMBERED_CHARS = 64


def zipf_scores(pieces: Iterable[str]) -> list[tuple[str, float]]:
    """Log probabilities of pieces in order of rank under Zipf's law: p(r) in proportion to 1 / (r + 1)."""
    pieces = list(pieces)
    total = math.fsum(1 / (rank + 1) for rank in range(len(pieces)))
    return [(piece, -math.log(rank + 1) - math.log(total)) for rank, piece in enumerate(pieces)]


class Counter(dict):
    """Word (with its mark) to number of pieces, remembered up to a bound."""

    def __init__(self, scores: list[tuple[str, float]]):
        super().__init__()
        known = dict(scores)
        self.automaton = ahocorasick.Automaton()
        for piece, score in known.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(map(len, known), default=1)
        self.unknown = min(known.values(), default=0.0) - UNKNOWN_PENALTY
        self.by_bytes = all(f"<0x{b:02X}>" in known for b in range(256))

    def __missing__(self, word: str) -> int:
        count = self.pieces(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def pieces(self, word: str) -> int:
        """Pieces on the best path over ``word``; only the last places that a piece can reach back to are held."""
        size = min(self.longest, len(word)) + 1
        score, count = [0.0] * size, [0] * size
        unknown = [False] * size  # the best path ends in a run of unknown characters
        hits = self.automaton.iter(word)  # by the place where a piece ends
        last, piece = next(hits, (-1, None))
        for end in range(1, len(word) + 1):
            here, alone = [], False  # alone: a piece covers just the character that ends here
            while last == end - 1:
                here.append(piece)
                alone |= piece[0] == 1
                last, piece = next(hits, (-1, None))
            best, start, missing = -math.inf, end - 1, True
            for length, value in sorted(here, reverse=True):  # the longest starts first
                if (found := score[(end - length) % size] + value) > best:
                    best, start, missing = found, end - length, False
            if not alone and (found := score[(end - 1) % size] + self.unknown) > best:
                best, start, missing = found, end - 1, True
            at, before = end % size, start % size
            if not missing:
                pieces = count[before] + 1
            elif self.by_bytes:
                pieces = count[before] + len(word[start].encode())
            else:
                pieces = count[before] + (not unknown[before])
            score[at], count[at], unknown[at] = best, pieces, missing
        return count[len(word) % size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        return sum(map(self.__getitem__, _WORD.findall(marked)))


_WORD = re.compile(f"{MARK}[^{MARK}]*")
_SHARED: dict[bytes, Counter] = {}


def _each(shipped):
    name, pieces = shipped.value
    if name not in _SHARED:
        _SHARED[name] = Counter(pieces)
    counter = _SHARED[name]
    return lambda texts: [[counter.count(text) for text in texts]]


def count_tokens(df: DataFrame, scores: list[tuple[str, float]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens long): pieces on the best path over each whole text.

    ``scores`` is the unigram vocabulary with log probabilities; of a repeated piece the last
    score holds. A null or empty text has no tokens; one row per input row, repeated rows
    included; other columns are left out. Row-local: no shuffle.
    """
    # A worker keeps the counter of each vocabulary, told by all its pieces and scores.
    name = hashlib.sha256(repr(list(scores)).encode()).digest()
    shipped = df.sparkSession.sparkContext.broadcast((name, scores))
    return map_text(df, partial(_each, shipped), (key, text), "n_tokens bigint", [pa.int64()])
