"""Language-model scoring by cross-entropy difference.

A target model (chosen texts) and a background model (all texts) are matched: one vocabulary, the
same order and smoothing. Per word, the target loss less the background loss says how much more
the word looks like the target; the mean over a text is its score, lower is closer.

A bigram's probability is its count smoothed by the unigram. ``score_whole`` counts every word and
every bigram of all texts: words and pairs are dealt to parts, whose number grows with the words;
a part counts its pairs and gives every text its share of the loss, so no model is ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import keyed, map_text, mixed, plain_words, slices, word_hashes, written

#: Weight of the unigram in words: counts of a history are smoothed by as many imagined ones.
PRIOR = 200.0
#: Target keys that are broadcast (some 40 bytes each).
BROADCAST_ROWS = 500_000
#: Words of texts that a task sorts by parts at a time, words of a part, and parts at least.
GATHERED = 800_000
PART_WORDS = 1_500_000
PARTS = 48
#: A word with more than a part's words divided by this is spread over all parts.
SPREAD = 8
#: The word before the first one.
START = np.uint64(0x5354415254)

_SHARE = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-24  # losses are summed as multiples of it, so that sums do not depend on their order


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of batches (text_key, text, target): keys, rows and target rows of distinct texts, hashes of their words, lengths."""
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> tuple[np.ndarray, ...]:
        keys, target, hashes, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(first)  # hashes stay in the order of the rows
        mine = np.zeros(len(lengths), bool)
        mine[first] = True
        rows, targets = np.bincount(back), np.bincount(back, target).astype(np.int64)
        return keys[order], rows[order], targets[order], hashes[np.repeat(mine, lengths)], lengths[mine]

    for batch in batches:
        for part in slices(batch, 1):
            keys, target = part.column(0).to_numpy(), np.array(part.column(2).to_pylist(), bool)
            hashes, lengths = word_hashes([plain_words(text) for text in part.column(1).to_pylist()])
            some = lengths > 0
            held.append((keys[some], target[some], hashes, lengths[some]))
            if sum(len(x[2]) for x in held) >= GATHERED:
                yield out()
    if held:
        yield out()


def whole_words(marked: DataFrame) -> DataFrame:
    """(word, background, target): how often each word, by hash, occurs in (text_key, text, target); ``START`` once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, targets, hashes, lengths in _gathered(batches):
            codes, words = pd.factorize(hashes)
            sums = [np.bincount(codes, np.repeat(x, lengths), len(words)).astype(np.int64) for x in (rows, targets)]
            sums = [np.append(x, y.sum()) for x, y in zip(sums, (rows, targets), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.append(words, START).view(np.int64), *sums)], ["word", "background", "target"])

    parts = marked.mapInArrow(run, "word long, background long, target long")
    return parts.groupBy("word").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def _dealt(marked: DataFrame, parts: int, spread: np.ndarray) -> DataFrame:
    """(part, docs, words, befores, entries): the pairs of words of all texts, packed, by the part that counts them.

    A pair goes where its second word belongs, so that a part has all of that word; pairs of the
    sorted words ``spread``, whose counts are known, go by the whole pair.
    """
    shipped = marked.sparkSession.sparkContext.broadcast(spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = shipped.value
        for keys, rows, targets, words, lengths in _gathered(batches):
            ends = np.cumsum(lengths)
            before = np.empty_like(words)
            before[1:] = words[:-1]
            before[ends - lengths] = START
            last = np.zeros(len(words), bool)
            last[ends - 1] = True
            doc = np.repeat(np.arange(len(keys), dtype=np.uint32), lengths)
            place = mixed(words * _SHARE)
            common = np.isin(words, spread)
            place[common] = mixed(words[common] * _SHARE + before[common])
            place = (place % np.uint64(parts)).astype(np.int64)
            for number, some in enumerate(np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place, minlength=parts))[:-1])):
                if not len(some):
                    continue
                some = some[np.lexsort((doc[some], before[some], words[some]))]
                w, b, d = words[some], before[some], doc[some]
                new = np.append(True, (w[1:] != w[:-1]) | (b[1:] != b[:-1]) | (d[1:] != d[:-1]))
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(w))).astype(np.uint32)
                final = np.add.reduceat(last[some].astype(np.uint32), at)
                starts = np.flatnonzero(np.append(True, w[at][1:] != w[at][:-1]))
                there, mine = np.unique(d[at], return_inverse=True)
                packed = {
                    "docs": np.stack([keys[there], rows[there], targets[there]]).astype(np.int64),
                    "words": np.stack([w[at][starts].view(np.int64), np.diff(np.append(starts, len(at)))]),
                    "befores": b[at],
                    "entries": np.stack([mine, times, final]).astype(np.uint32),
                }
                arrays = [pa.array([number], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed.values())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", *packed])

    return marked.mapInArrow(run, "part int, docs binary, words binary, befores binary, entries binary")


def score_whole(df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, target_loss, background_loss, score) of each whole text, losses in nats a word.

    All rows of ``df`` are background; those whose key is among the rows (key) of ``targets`` are
    target as well. Null keys are no targets. Every word and every bigram of ``df`` counts by itself;
    words are told apart by 64-bit hashes. What comes to the driver is a few sums and the words that
    make up more than a share of a part. ``score`` is the mean difference of the losses. A text
    without words (null, empty) has null losses and a null score. One row per input row.
    """
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    keys = targets.where(F.col(key).isNotNull()).select(F.col(key).alias("target_id")).distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    marked = rows.join(keys, F.col("id") == F.col("target_id"), "left")
    marked = marked.select(F.xxhash64("text").alias("text_key"), "text", F.col("target_id").isNotNull().alias("target"))
    words = written(whole_words(marked), "lm-words")
    start = F.col("word") == int(START)
    sums = words.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("background", "target")), F.count(F.when(~start, 1))).first()
    starts = words.where(start).select("background", "target").first() or (0, 0)
    parts = max(PARTS, -(-sums[0] // PART_WORDS))
    common = words.where(~start & (F.col("background") > sums[0] / (parts * SPREAD))).toPandas().sort_values("word")
    counts = [common[x].to_numpy() for x in ("target", "background")]
    spread = common["word"].to_numpy()
    totals, firsts = (sums[1] + sums[2] + 2, sums[0] + sums[2] + 2), (starts[1], starts[0])
    shipped = df.sparkSession.sparkContext.broadcast((spread, counts))

    def share(packed: pd.DataFrame) -> pd.DataFrame:
        spread, known = shipped.value
        docs = [np.frombuffer(x, np.int64).reshape(3, -1) for x in packed["docs"]]
        runs = [np.frombuffer(x, np.int64).reshape(2, -1) for x in packed["words"]]
        entries = [np.frombuffer(x, np.uint32).reshape(3, -1) for x in packed["entries"]]
        offsets = np.cumsum([0, *(x.shape[1] for x in docs)])
        owner = np.concatenate([x[0].astype(np.int64) + at for x, at in zip(entries, offsets, strict=False)])
        times, final = (np.concatenate([x[i] for x in entries]).astype(np.int64) for i in (1, 2))
        before = np.concatenate([np.frombuffer(x, np.uint64) for x in packed["befores"]])
        word, words = pd.factorize(np.concatenate([np.repeat(x[0], x[1]) for x in runs]))
        history, befores = pd.factorize(before)
        pair = pd.factorize(word * len(befores) + history)[0]
        keys, rows, targets = np.concatenate(docs, axis=1)
        first = before == START
        common = np.searchsorted(spread, words)
        common[common == len(spread)] = 0
        is_common = (spread[common] == words) if len(spread) else np.zeros(len(words), bool)
        out = {"text_key": keys}
        for name, weight, total, begun, have in zip(("target_loss", "background_loss"), (targets, rows), totals, firsts, known, strict=True):
            weighted = times * weight[owner]
            unigram = np.bincount(word, weighted, len(words))
            if len(spread):
                unigram = np.where(is_common, have[common], unigram)
            both = np.bincount(pair, weighted)[pair]
            loss = -times * np.log(both + PRIOR * ((unigram + 1) / total)[word])
            loss += (times - final) * np.log(unigram + PRIOR)[word] + first * np.log(begun + PRIOR)
            out[name] = np.bincount(owner, np.rint(loss / _UNIT), len(keys)).astype(np.int64)
        out["n"] = np.bincount(owner, times, len(keys)).astype(np.int64)
        return pd.DataFrame(out)

    names = ("target_loss", "background_loss", "n")
    shares = _dealt(marked, parts, spread.view(np.uint64)).groupBy("part").applyInPandas(share, "text_key long, target_loss long, background_loss long, n long")
    # A text is in several shares once for each time it was gathered: sums and words alike.
    scored = written(shares.groupBy("text_key").agg(*(F.sum(x).alias(x) for x in names)), "lm-losses")
    means = [(F.col(x) * _UNIT / F.col("n")).alias(x) for x in names[:2]]
    scored = scored.select(F.col("text_key").alias("_text_key"), *means)
    if scored.count() <= BROADCAST_ROWS:
        scored = F.broadcast(scored)

    def make() -> Callable[[list], list]:
        return lambda texts: [[len(plain_words(text)) for text in texts]]

    counted = map_text(keyed(df, key, text), make, ("doc_id", "text_key", "text"), "n_words bigint", [pa.int64()])
    out = counted.join(scored, (F.col("text_key") == F.col("_text_key")) & (F.col("n_words") > 0), "left")
    return out.select(F.col("doc_id").alias(key), "n_words", *names[:2], (F.col("target_loss") - F.col("background_loss")).alias("score"))
