"""Fixed-size byte chunks: cut, fetch, verify."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_BYTES = 8 * 1024 * 1024
MIN_CHUNK_BYTES = 1
MAX_CHUNK_BYTES = 512 * 1024 * 1024


def check_chunk_size(chunk_bytes: int) -> int:
    if not MIN_CHUNK_BYTES <= chunk_bytes <= MAX_CHUNK_BYTES:
        raise ValueError(f"chunk size must be {MIN_CHUNK_BYTES}..{MAX_CHUNK_BYTES} bytes, not {chunk_bytes}")
    return chunk_bytes


def cut_chunks(files: DataFrame, chunk_bytes: int = DEFAULT_CHUNK_BYTES) -> DataFrame:
    """(document_id, content) -> one row per chunk; an empty file has none.

    The slices are made before they become rows, so the content is never copied per row,
    and no shuffle takes part. (The outer generator keeps the optimizer from adding a size
    test that would cut all slices twice.)
    """
    check_chunk_size(chunk_bytes)
    size = F.lit(chunk_bytes)
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("content") - 1) / size).cast("int")),
        lambda i: F.struct(
            i.alias("chunk_index"),
            (i.cast("long") * size).alias("byte_offset"),
            F.substr("content", (i.cast("long") * size).cast("int") + 1, size).alias("content"),
        ),
    )
    return (
        files.where(F.length("content") > 0)
        .select("document_id", F.inline_outer(pieces))
        .select(
            "document_id", "chunk_index", "byte_offset",
            F.length("content").alias("chunk_length_bytes"), "content",
        )
    )


def fetch_chunks(chunks: DataFrame, documents: DataFrame, file_name: str) -> DataFrame:
    """Chunks of the documents with this name, in order."""
    named = documents.where(F.col("file_name") == file_name).select("document_id")
    return chunks.join(named, "document_id", "left_semi").orderBy("document_id", "chunk_index")


REBUILT = (
    "document_id string, sha256_hex string, file_size_bytes long, chunk_count int, contiguous boolean"
)


def _running_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash chunk rows that arrive sorted by (document_id, chunk_index); one chunk held at a time."""
    schema = pa.schema([
        ("document_id", pa.string()), ("sha256_hex", pa.string()), ("file_size_bytes", pa.int64()),
        ("chunk_count", pa.int32()), ("contiguous", pa.bool_()),
    ])
    current, digest, size, count, contiguous = None, None, 0, 0, True
    done: list[dict] = []

    def finished() -> dict:
        return {
            "document_id": current, "sha256_hex": digest.hexdigest(), "file_size_bytes": size,
            "chunk_count": count, "contiguous": contiguous,
        }

    for batch in batches:
        ids, indexes, offsets, contents = (
            batch.column(name) for name in ("document_id", "chunk_index", "byte_offset", "content")
        )
        for i in range(batch.num_rows):
            document = ids[i].as_py()
            if document != current:
                if current is not None:
                    done.append(finished())
                current, digest, size, count, contiguous = document, hashlib.sha256(), 0, 0, True
            block = contents[i].as_buffer()
            contiguous = contiguous and indexes[i].as_py() == count and offsets[i].as_py() == size
            digest.update(block)
            size += block.size
            count += 1
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if current is not None:
        yield pa.RecordBatch.from_pylist([finished()], schema=schema)


def rebuild_hashes(chunks: DataFrame) -> DataFrame:
    """(document_id, sha256_hex, file_size_bytes, chunk_count, contiguous) of the chunks in order.

    Chunks are brought together by document and sorted, then hashed as a stream: a whole
    file is never held in memory, however many chunks it has. A hash has to see its bytes in
    order, so one file is one task's work, but a sort spills and the hash keeps one chunk.
    """
    return (
        chunks.select("document_id", "chunk_index", "byte_offset", "content")
        .repartition("document_id")
        .sortWithinPartitions("document_id", "chunk_index")
        .mapInArrow(_running_hashes, REBUILT)
    )


def verify_chunks(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per document: do the stored chunks give back the recorded hash, size and count?"""
    found = rebuild_hashes(chunks).select(
        "document_id",
        F.col("sha256_hex").alias("rebuilt_sha256_hex"),
        F.col("file_size_bytes").alias("rebuilt_size_bytes"),
        F.col("chunk_count").alias("rebuilt_chunk_count"),
        "contiguous",
    )
    empty = hashlib.sha256(b"").hexdigest()
    joined = documents.select("document_id", "sha256_hex", "file_size_bytes", "chunk_count").join(
        found, "document_id", "left"
    )
    rebuilt = F.coalesce("rebuilt_sha256_hex", F.lit(empty))
    size = F.coalesce("rebuilt_size_bytes", F.lit(0))
    count = F.coalesce("rebuilt_chunk_count", F.lit(0))
    return joined.select(
        "document_id", "sha256_hex", "file_size_bytes",
        rebuilt.alias("rebuilt_sha256_hex"),
        size.alias("rebuilt_size_bytes"),
        (
            (rebuilt == F.col("sha256_hex"))
            & (size == F.col("file_size_bytes"))
            & (count == F.col("chunk_count"))
            & F.coalesce("contiguous", F.lit(True))
        ).alias("intact"),
    )


#: Digests that one node of the hash tree is over.
TREE_FANOUT = 1024


def with_digest(chunks: DataFrame) -> DataFrame:
    """Chunk rows with ``chunk_sha256``, the leaf of the hash tree; made where the row is."""
    return chunks.withColumn("chunk_sha256", F.sha2("content", 256))


def tree_roots(leaves: DataFrame) -> DataFrame:
    """(document_id, content_root) of (document_id, chunk_index, chunk_sha256).

    Level by level ``TREE_FANOUT`` digests in order make one, here in two steps: a node is the hash of its
    digests put together. So a document of very many chunks is the work of many tasks.
    """
    node = F.floor(F.col("chunk_index") / TREE_FANOUT).alias("node")
    nodes = leaves.groupBy("document_id", node).agg(
        F.expr("sha2(listagg(chunk_sha256, '') WITHIN GROUP (ORDER BY chunk_index), 256)").alias("digest")
    )
    return nodes.groupBy("document_id").agg(F.expr("sha2(listagg(digest, '') WITHIN GROUP (ORDER BY node), 256)").alias("content_root"))


def verify_tree(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per document: which chunks are damaged, and is the document what its root says?

    ``chunks`` come as stored, with ``chunk_sha256``; ``documents`` with ``content_root``. Every chunk is
    hashed where it is read: what is shuffled are digests and numbers, never ``content``, and a long
    file is the work of as many tasks as it has row groups. ``damaged_chunks`` are the numbers of the
    chunks whose bytes do not give their digest; a chunk that is missing, repeated or has another
    digest changes the root.
    """
    read = chunks.select(
        "document_id", "chunk_index", "chunk_length_bytes", "chunk_sha256",
        (F.coalesce(F.sha2("content", 256) != F.col("chunk_sha256"), F.lit(True)) | (F.length("content") != F.col("chunk_length_bytes"))).alias("damaged"),
    )
    totals = read.groupBy("document_id").agg(
        F.count("*").alias("stored"), F.sum("chunk_length_bytes").alias("bytes"),
        F.array_sort(F.collect_list(F.when(F.col("damaged"), F.col("chunk_index")))).alias("damaged_chunks"),
    )
    found = totals.join(tree_roots(read).withColumnRenamed("content_root", "found_root"), "document_id")
    kept = documents.select("document_id", "file_size_bytes", "chunk_count", "content_root").join(found, "document_id", "left")
    damaged = F.coalesce("damaged_chunks", F.array().cast("array<int>"))
    return kept.select(
        "document_id", "chunk_count", "content_root", damaged.alias("damaged_chunks"),
        (
            (F.size(damaged) == 0) & F.col("content_root").eqNullSafe(F.col("found_root"))
            & (F.coalesce("stored", F.lit(0)) == F.col("chunk_count"))
            & (F.coalesce("bytes", F.lit(0)) == F.col("file_size_bytes"))
        ).alias("intact"),
    )


def chunk_gaps(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Completeness per document by numbers alone; ``content`` is never read.

    All totals pre-aggregate before the shuffle, so a huge file is no hot group.
    """
    totals = chunks.groupBy("document_id").agg(
        F.count("*").alias("stored"),
        F.sum("chunk_length_bytes").alias("bytes"),
        F.max("chunk_index").alias("last_index"),
        F.max(F.col("byte_offset") + F.col("chunk_length_bytes")).alias("end_offset"),
    )
    joined = documents.select("document_id", "file_size_bytes", "chunk_count").join(
        totals, "document_id", "left"
    )
    stored = F.coalesce("stored", F.lit(0))
    stored_bytes = F.coalesce("bytes", F.lit(0))
    return joined.select(
        "document_id",
        F.col("chunk_count").alias("expected_chunks"),
        stored.alias("stored_chunks"),
        stored_bytes.alias("stored_bytes"),
        (
            (stored == F.col("chunk_count"))
            & (F.coalesce(F.col("last_index") + 1, F.lit(0)) == stored)
            & (stored_bytes == F.col("file_size_bytes"))
            & (F.coalesce("end_offset", F.lit(0)) == F.col("file_size_bytes"))
        ).alias("complete"),
    )


def chunk_order(chunks: DataFrame) -> DataFrame:
    """Every chunk with the offset it should have, and whether it continues the chunk before it.

    Chunk k is matched with chunk k-1 by an equi join on the unique pair (document, index), so a
    document with very many chunks spreads over all tasks; a window would sort it in one.
    """
    keys = chunks.select("document_id", "chunk_index", "byte_offset", "chunk_length_bytes")
    before = keys.select(
        "document_id",
        (F.col("chunk_index") + 1).alias("chunk_index"),
        (F.col("byte_offset") + F.col("chunk_length_bytes")).alias("_end"),
    )
    expected = F.when(F.col("chunk_index") == 0, F.lit(0).cast("long")).otherwise(F.col("_end"))
    return keys.join(before, ["document_id", "chunk_index"], "left").select(
        "document_id", "chunk_index", "byte_offset", expected.alias("expected_offset"),
        F.coalesce(F.col("byte_offset") == expected, F.lit(False)).alias("continues"),
    )
