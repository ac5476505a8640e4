"""The segments of a search index: written per load, merged by size, each page in one of them.

An index is a folder with ordinary Parquet tables:

``postings/segment=S/bucket=B`` (block, term, doc_keys, page_number, tf, page_len, df, total_tf, max_tf, min_len)
    one row per term and block of pages, by a hash bucket of the term, sorted by term. The first columns are
    lists over the pages of the block that hold the term, the last ones sums and extremes of the lists.
``terms/segment=S/bucket=B`` (term, df, total_tf, max_tf, min_len)
    statistics of the segment; those of the index are their sums (or extremes) at query time.
``pages/segment=S``
    the page text of the segment, where the index is built over a copy.
``version=V`` with ``segments`` (one row per segment), ``loads`` (which load is in which segment) and
    ``dead`` (documents of a segment that a later, indexed load replaced or deleted).

A load adds a segment of its own pages; nothing older is read. Where ``FACTOR`` segments are of one
size class, the next update makes one of them from their postings, without reading any text, so the
number of segments grows with the logarithm of the pages and a posting is rewritten as often.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import ranking

#: Segments of one size class that are merged, and the ratio of sizes between classes.
FACTOR = 4
#: Pages of the largest segment of the lowest class.
SMALL_PAGES = 10_000
#: Largest dictionary of a column in a row group, some 800,000 document keys.
DICTIONARY_BYTES = 16 << 20
#: Share of dead documents from which a segment is written anew without them.
DEAD_SHARE = 0.1

SEGMENT = (
    "segment string, n_pages long, n_tokens long, n_documents long, n_dead long, last_load string, buckets int, "
    "stemmer string, stop_words array<string>, copied boolean"
)
LOADS = "load_id string, segment string"
DEAD = "segment string, doc_key binary"


@dataclass(frozen=True)
class Settings:
    """What all segments of an index share."""

    buckets: int
    stemmer: str
    stop_words: tuple[str, ...]
    copied: bool


def size_class(n_pages: int) -> int:
    return max(0, math.ceil(math.log(max(n_pages, 1) / SMALL_PAGES, FACTOR)))


def merges(sizes: dict[str, int], worn: set[str]) -> list[list[str]]:
    """Which segments an update makes one of: full size classes, also those that merging fills; and each worn one."""
    groups = [([name], n) for name, n in sizes.items()]
    while True:
        classes: dict[int, list] = {}
        for group in groups:
            classes.setdefault(size_class(group[1]), []).append(group)
        full = next((c for c in sorted(classes) if len(classes[c]) >= FACTOR), None)
        if full is None:
            return [sorted(names) for names, _ in groups if len(names) > 1 or names[0] in worn]
        merged = ([name for names, _ in classes[full] for name in names], sum(n for _, n in classes[full]))
        groups = [g for g in groups if g not in classes[full]] + [merged]


def _sorted_write(rows: DataFrame, path: str) -> None:
    """Rows, dealt out by bucket, to folders by bucket, sorted by term."""
    writer = rows.sortWithinPartitions("bucket", "term").write.mode("overwrite")
    # A document is in many lists of a file: its key is written once, also where there are very many documents.
    writer.option("parquet.dictionary.page.size", str(DICTIONARY_BYTES)).partitionBy("bucket").parquet(path)


def _write_terms(spark: SparkSession, base: str, segment: str) -> int:
    """Writes the statistics of a segment's postings; returns its number of tokens."""
    lists = spark.read.schema(ranking.POSTINGS).parquet(f"{base}/postings/segment={segment}")
    _sorted_write(ranking.term_statistics(lists).hint("rebalance", "bucket"), f"{base}/terms/segment={segment}")
    terms = spark.read.schema(ranking.TERMS).parquet(f"{base}/terms/segment={segment}")
    return terms.agg(F.coalesce(F.sum("total_tf"), F.lit(0))).first()[0]


def write_segment(pages: DataFrame, base: str, segment: str, settings: Settings, n_pages: int) -> int:
    """Writes a segment of ``pages``, of which there are ``n_pages``; returns its number of tokens.

    One pass over the text. Each task packs the postings of its pages into lists; the only shuffle
    brings these to their bucket, in parcels.
    """
    spark = pages.sparkSession
    if settings.copied:
        pages.write.mode("overwrite").parquet(f"{base}/pages/segment={segment}")
        pages = spark.read.schema(pages.schema).parquet(f"{base}/pages/segment={segment}")
    parts = ranking.bucket_parts(n_pages, settings.buckets)
    parcels = ranking.page_parcels(pages, list(settings.stop_words), settings.stemmer, settings.buckets, parts)
    _sorted_write(ranking.deliver(parcels, settings.buckets, parts), f"{base}/postings/segment={segment}")
    return _write_terms(spark, base, segment)


def merge_segments(index: ranking.SearchIndex, members: list[str], segment: str) -> int:
    """Writes one segment from the living postings of others, whose text is not read; returns its number of tokens.

    Lists are taken over as they are, unless some of their documents are dead or a segment has so few pages that
    its lists are short; then they are packed anew.
    """
    base, spark = index.base, index.spark
    inside = F.col("segment").isin(members)
    smallest = min(row.n_pages for row in index.segments if row.segment in members)
    n_pages = sum(row.n_pages for row in index.segments if row.segment in members)
    if index.n_dead or smallest <= SMALL_PAGES:
        # A block per so many documents: blocks of small segments would stay as small.
        block = F.pmod(F.xxhash64("doc_key"), F.lit(1 + n_pages // SMALL_PAGES))
        lists = ranking.pack(index.postings.where(inside).withColumn("block", block))
    else:
        lists = index.lists.where(inside)
    buckets = index.settings.buckets
    parts = ranking.bucket_parts(n_pages, buckets)
    parcels = ranking.parcels(lists, buckets, parts)
    _sorted_write(ranking.deliver(parcels, buckets, parts), f"{base}/postings/segment={segment}")
    if index.segments[0].copied:
        pages = index.pages.where(F.col("segment").isin(members))
        if index.n_dead:
            key = ranking.identity.document_key(F.col("document_id")).alias("doc_key")
            pages = pages.withColumn("doc_key", key).join(index.dead, ["segment", "doc_key"], "left_anti")
        pages.drop("segment", "doc_key").write.mode("overwrite").parquet(f"{base}/pages/segment={segment}")
    return _write_terms(spark, base, segment)
