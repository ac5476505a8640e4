"""Quality classification by importance resampling.

Two generative models over hashed character n-grams, one of good texts and one of all texts, give
every n-gram a log ratio. A text's importance weight is the sum over its worst window: over a
whole text the sum would drown a short bad passage. The smallest of many windows is smaller by chance
alone: a good text has a window of log ratio t or less with a chance of e^t at most, for each of its
windows, so the weight allows the logarithm of their number. Texts are resampled by Gumbel top-k: noise is
added to the weights and the k largest stay, k being the number of texts whose weight reaches a
threshold learned from labelled texts. Far from the threshold the noise changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import keyed, map_text, mixed, slices, written

#: Bytes of an n-gram, cells of the hash table, n-grams of a window, imagined count of a cell.
GRAM = 5
BUCKETS = 1 << 18
WINDOW = 32
PRIOR = 0.5
#: Windows of a text that need no allowance.
FEW_WINDOWS = 8
#: Labelled texts used at most; a half of the good ones trains, the rest sets the threshold.
SAMPLE_ROWS = 20_000
#: Share of good texts that the threshold may lose.
LOST = 0.005
#: Rows among which the k-th largest is found by sorting.
SORTED_ROWS = 5_000

_UNIT = 2.0**-20  # weights are multiples of it, so that sums do not depend on their order


def cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams end to end, and their number in each text."""
    data = [text.encode() if text else b"" for text in texts]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    count = np.maximum(lengths - GRAM + 1, 0)
    codes = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    last = len(codes) - GRAM + 1
    if last <= 0:
        return np.zeros(0, np.int64), count
    value = np.zeros(last, np.uint64)
    for j in range(GRAM):
        value = value << np.uint64(8) | codes[j : last + j]
    ends = np.repeat(np.cumsum(lengths), lengths)
    inside = np.arange(last) + GRAM <= ends[:last]
    return (mixed(value[inside]) % np.uint64(BUCKETS)).astype(np.int64), count


def worst_windows(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each text the smallest sum over windows that overlap by half; 0 without n-grams.

    From ``FEW_WINDOWS`` on the logarithm of the windows (as a multiple of so many) is added, so that
    a long text is as likely to reach a threshold as a short one of the same kind.
    """
    sums = np.concatenate([[0.0], np.cumsum(values)])
    first = np.cumsum(count) - count
    step = WINDOW // 2
    windows = np.maximum(1, -(-(count - step) // step))
    owner = np.repeat(np.arange(len(count)), windows)
    at = (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)) * step
    start = first[owner] + np.minimum(at, count[owner])
    end = first[owner] + np.minimum(at + WINDOW, count[owner])
    if not len(count):
        return np.zeros(0)
    allowed = np.rint(np.log(np.maximum(windows / FEW_WINDOWS, 1)) / _UNIT) * _UNIT
    return np.minimum.reduceat(sums[end] - sums[start], np.cumsum(windows) - windows) + allowed


@dataclass
class Model:
    """Log ratios of cells, and the least weight of an accepted text."""

    ratios: np.ndarray
    threshold: float


def _counts(df: DataFrame) -> DataFrame:
    """(cell, raw, target) of (text, is_target): counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                found, count = cells(part.column(0).to_pylist())
                target = np.repeat(np.array(part.column(1).to_pylist(), bool), count)
                sums[0] += np.bincount(found, minlength=BUCKETS)
                sums[1] += np.bincount(found[target], minlength=BUCKETS)
        some = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], ["cell", "raw", "target"])

    return df.mapInArrow(run, "cell long, raw long, target long").groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def _weights(df: DataFrame, ratios: np.ndarray, columns: tuple[str, ...]) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(ratios)

    def make() -> Callable[[list], list]:
        def work(texts: list[str | None]) -> list:
            found, count = cells(texts)
            return [worst_windows(shipped.value[found], count)]

        return work

    return map_text(df, make, columns, "weight double", [pa.float64()])


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """A model from the texts of ``df`` and the rows (key, is_good) of ``labels``.

    The raw model counts every text; the target model those of a bounded sample of labelled good
    texts. Labelled ids are broadcast, ``SAMPLE_ROWS`` at most, those with the smallest hash. Of
    an id with several labels any bad one counts. Without good texts all ratios are 0 and
    everything is accepted.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col("is_good").isNotNull()).groupBy(key).agg(F.min("is_good").alias("_good"))
    part = F.pmod(F.xxhash64(F.col(key), F.lit("part")), F.lit(2)) == 0
    chosen = marked.withColumn("_place", F.xxhash64(key)).orderBy("_place", key).limit(SAMPLE_ROWS)
    chosen = chosen.select(F.col(key).alias("_key"), "_good", part.alias("_train"))
    chosen = written(chosen, "quality-sample")
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    flagged = rows.join(F.broadcast(chosen), F.col("id") == F.col("_key"), "left")
    is_target = F.coalesce(F.col("_good") & F.col("_train"), F.lit(False))
    table = _counts(flagged.select("text", is_target.alias("is_target"))).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table.column("cell").to_numpy()] = table.column("raw").to_numpy()
    target[table.column("cell").to_numpy()] = table.column("target").to_numpy()
    if not target.sum():
        return Model(np.zeros(BUCKETS), -math.inf)
    logs = [np.log((x + PRIOR) / (x.sum() + PRIOR * BUCKETS)) for x in (target, raw)]
    ratios = np.rint((logs[0] - logs[1]) / _UNIT) * _UNIT
    held = rows.join(F.broadcast(chosen.where("_good AND NOT _train")), F.col("id") == F.col("_key"))
    seen = _weights(held.select(F.col("id").alias("doc_id"), "text"), ratios, ("doc_id", "text"))
    weights = np.sort([row["weight"] for row in seen.select("weight").collect()])
    return Model(ratios, float(weights[int(LOST * len(weights))]) if len(weights) else -math.inf)


def cut(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of ``column``: the range of values is narrowed by counting in bins."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    left, n = k, None
    while high > low and (n is None or n > SORTED_ROWS):
        width = (high - low) / 1024
        if low + width == low:
            break
        place = F.least(F.floor((F.col(column) - low) / width).cast("int"), F.lit(1023))
        bins = df.where(F.col(column).between(low, high)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if row["n"] >= left:
                low, high, n = row["low"], row["high"], row["n"]
                break
            left -= row["n"]
    if high == low:
        return low
    rows = df.where(F.col(column).between(low, high)).select(column).orderBy(F.desc(column)).limit(left).collect()
    return rows[-1][0]


def classify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """(key, text_key, weight, sampling_key, accepted) of each whole text.

    ``accepted`` marks the k texts with the largest weight plus Gumbel noise, k being the number of
    texts whose weight reaches the threshold; texts that tie with the k-th stay as well. The noise
    is made from the row's id and text, so a lost task repeats it and repeated rows share it. A null
    or empty text, or one shorter than an n-gram, weighs 0. An empty table gives no rows.
    """
    rows = _weights(keyed(df, key, text), model.ratios, ("doc_id", "text_key", "text"))
    chance = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_key"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = written(rows.withColumn("sampling_key", F.col("weight") - F.log(-F.log(chance))), "quality-weights")
    k = noisy.where(F.col("weight") >= model.threshold).count()
    least = cut(noisy, "sampling_key", k) if k else math.inf
    return noisy.select(F.col("doc_id").alias(key), "text_key", "weight", "sampling_key", (F.col("sampling_key") >= least).alias("accepted"))


def good(labels: DataFrame) -> DataFrame:
    """(doc_id, is_good) of the labels table: of quality, and not toxic."""
    is_good: Column = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return labels.select("doc_id", is_good.alias("is_good"))
