"""Substring search by character trigrams: an inverted index that names candidate pages, which are then verified.

``grams/load_id=L/bucket=B`` (gram, file_key, rows)
    for each run of three characters of lower-cased page text the rows that hold it, by the place
    of the page in the store: a hash of the file's name, and row numbers within that file.

A page that contains a term holds all trigrams of the term's literal parts. A search intersects their
postings, leaves out all files without a candidate (a filter on the scan's file listing) and tests the
pattern on candidate pages alone. Terms whose literal parts are all shorter than three characters
have no trigram and are looked for in every page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators.ranking import any_of

#: Pages whose trigrams a task sorts at a time.
BLOCK_PAGES = 1_024
#: Trigrams of a long term that are looked up; verification does not depend on it.
LOOKED_UP = 64
BUCKETS = 64

GRAMS = "gram long, file_key long, rows array<int>, bucket int, load_id string"


def page_grams(body: str | None) -> np.ndarray:
    """The distinct trigrams of a text as numbers: 21 bits for each character."""
    codes = np.frombuffer((body or "").encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]) if len(codes) > 2 else codes[:0]


def file_key() -> Column:
    """Names of part files hold an id of their job, so they are unique without their folder."""
    return F.xxhash64("_metadata.file_name")


def with_place(pages: DataFrame) -> DataFrame:
    """Page rows, just as they are read, with the place where they are stored."""
    return pages.select("*", file_key().alias("file_key"), F.col("_metadata.row_index").cast("int").alias("row"))


def postings(pages: DataFrame) -> DataFrame:
    """(gram, file_key, rows) of page rows with their place; a task hands on sorted blocks of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_PAGES):
                part = batch.slice(at, BLOCK_PAGES)
                found = [page_grams(body) for body in part.column(2).to_pylist()]
                sizes = [len(x) for x in found]
                grams = np.concatenate(found)
                files = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
                rows = np.repeat(part.column(1).to_numpy(zero_copy_only=False), sizes)
                order = np.lexsort((rows, files, grams))
                grams, files, rows = grams[order], files[order], rows[order]
                first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (files[1:] != files[:-1]))) if len(grams) else np.zeros(0, int)
                offsets = pa.array(np.append(first, len(grams)).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(grams[first]), pa.array(files[first]), lists], ["gram", "file_key", "rows"])

    lowered = pages.select("file_key", "row", F.lower("page_text").alias("body"))
    return lowered.mapInArrow(run, "gram long, file_key long, rows array<int>")


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_grams(pages: DataFrame, path: str) -> None:
    """Postings of one load, in folders by bucket and sorted by trigram; text is read once and not shuffled."""
    rows = postings(with_place(pages)).withColumn("bucket", bucket_of(F.col("gram")))
    writer = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite")
    # Row numbers and trigrams are sorted: the second page format stores their differences.
    writer.option("parquet.writer.version", "v2").partitionBy("bucket").parquet(path)


def term_grams(spark: SparkSession, term: str) -> list[int]:
    """The trigrams that a page with the term must hold; lower-cased by Spark, just like the pages."""
    lowered = spark.sql("SELECT lower(:term) AS term", args={"term": term}).first()["term"]
    found = np.unique(np.concatenate([page_grams(part) for part in re.split("[%_]", lowered)]))
    step = max(1, -(-len(found) // LOOKED_UP))
    return found[::step].tolist()


def candidates(index: DataFrame, wanted: list[int]) -> DataFrame:
    """(file_key, row): pages that hold all of the trigrams."""
    buckets = [r[0] for r in index.sparkSession.createDataFrame([(g,) for g in wanted], "gram long").select(bucket_of(F.col("gram"))).distinct().collect()]
    lists = index.where(F.col("bucket").isin(sorted(buckets)) & any_of("gram", wanted))
    held = lists.select("file_key", F.explode("rows").alias("row")).groupBy("file_key", "row").agg(F.count("*").alias("n"))
    return held.where(F.col("n") == len(wanted)).select("file_key", "row")


def matching_pages(pages: DataFrame, index: DataFrame, term: str, wanted: list[int]) -> DataFrame:
    """Rows of ``pages``, just as they are read, that contain the term; only files with a candidate are opened."""
    found = candidates(index, wanted)
    # Keys of files, which the driver lists anyway.
    keys = [row[0] for row in found.select("file_key").distinct().collect()]
    placed = with_place(pages.where(file_key().isin(keys) if keys else F.lit(False)))
    return placed.join(found, ["file_key", "row"], "left_semi").where(text.contains_term(F.col("page_text"), term)).drop("file_key", "row")
