"""What the operators share: reading tables, scratch tables, row-local Python over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import shared_dir

#: Words are runs of other than ASCII blanks, controls and punctuation, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same runs in text that still has A-Z.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Rows and characters that one call of a row-local function sees at a time: bounds a worker's lists.
SLICE_ROWS = 512
SLICE_CHARS = 1_000_000


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_text(
    df: DataFrame,
    make: Callable[[], Callable[[list], Sequence]],
    columns: Sequence[str],
    schema: str,
    types: Sequence[pa.DataType],
) -> DataFrame:
    """Row-local Python: ``columns[:-1]`` pass through, the last one is worked on.

    ``make()`` runs once per task and returns a function from a list of values to one list per
    new column; ``types`` are the Arrow types of these. Batches are cut to ``SLICE_ROWS`` rows.
    """
    kept = list(columns[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, len(kept)):
                found = work(part.column(len(kept)).to_pylist())
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(found, types, strict=True)]
                names = kept + [f"_{i}" for i in range(len(found))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    passed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields)
    new = [part.strip().split(" ")[0] for part in schema.split(",")]
    raw = ", ".join(f"_{i} {part.strip().split(' ', 1)[1]}" for i, part in enumerate(schema.split(",")))
    out = df.select(*columns).mapInArrow(run, f"{passed}, {raw}" if kept else raw)
    return out.withColumnsRenamed({f"_{i}": name for i, name in enumerate(new)})


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with bounded rows and text; a text that is longer comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        ends = np.cumsum(sizes[at : at + SLICE_ROWS])
        rows = max(1, int(np.searchsorted(ends, SLICE_CHARS, side="right")))
        yield batch.slice(at, rows)
        at += rows


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SHARE = np.uint64(0x9E3779B97F4A7C15)


def plain_words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and all non-ASCII characters, A-Z in lower case."""
    return _WORD.findall(text.encode().lower()) if text else []


def blank_words(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers scattered evenly."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def word_hashes(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words end to end, and the number of words of each list."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    codes, known = pd.factorize(np.array([w for words in lists for w in words], object))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    return hashes[codes], lengths


def grams(hashes: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that stay within a list, and their number per list."""
    count = np.maximum(lengths - n + 1, 0)
    last = len(hashes) - n + 1
    if last <= 0:
        return np.zeros(0, np.uint64), count
    value = np.full(last, n, np.uint64)
    for j in range(n):
        value = value * _SHARE + hashes[j : last + j]
    ends = np.repeat(np.cumsum(lengths), lengths)
    return mixed(value[np.arange(last) + n <= ends[:last]]), count


def long_lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """Arrow lists of 64-bit integers, ``count`` for each row."""
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` worked out once: the optimizer may copy a column into lambdas, which run for each element."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would change other letters too)."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: str) -> Column:
    """Number of words; 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RAW_WORD), F.lit(0))).cast("long")


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_key, text): rows told apart by id and text, so that repeated ids keep apart."""
    return df.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))


def with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``found`` has for their (doc_id, text_key); null ids match null ids."""
    other = found.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    match = rows["doc_id"].eqNullSafe(other["_doc_id"]) & (rows["text_key"] == other["_text_key"])
    return rows.join(other, match, "left").drop("_doc_id", "_text_key")


def comma_sha256(items: Column) -> Column:
    """Lower-case hex SHA-256 of the comma-joined strings."""
    return F.sha2(F.concat_ws(",", items), 256)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
