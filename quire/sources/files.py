"""Files: listing, attributes, hashes, inspection, byte ranges.

A *file row* has ``ordinal, file_path, file_name, file_size_bytes, file_modified_at`` and,
when the bytes already sit in a table, ``content``. Without ``content`` the jobs below read
the bytes by path inside the tasks, in blocks, so that no whole file becomes a row.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import identity, mime
from quire.functions.pdf_dates import parse_pdf_date
from quire.operators.chunks import DEFAULT_CHUNK_BYTES, check_chunk_size
from quire.schemas import FILE_INFO
from quire.session import shared_dir

READ_BLOCK_BYTES = 4 * 1024 * 1024
TASK_BYTES = 512 * 1024 * 1024
HEAD_BYTES = 16


def open_uri(uri: str) -> BinaryIO:
    """Open a path or URI for seekable reading on a worker (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return open("/" + uri[len("file:"):].lstrip("/"), "rb")
    if "://" not in uri:
        return open(uri, "rb")
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(path)


def scan_files(
    spark: SparkSession,
    paths: list[str] | None = None,
    source_dir: str | None = None,
    suffix: str = "pdf",
) -> DataFrame:
    """Explicit paths first, in the given order, then the directory's files with the suffix.

    The directory is listed without its sub-folders, the suffix matches in any case, and its
    files come sorted by path. Explicit paths are taken whatever their suffix, and literally:
    no character of theirs is a wildcard. One that names no file is an error. Only listing
    columns are read here, never the bytes; the numbered listing is written to the shared
    folder, so that every use of the result has the same numbers.
    """
    if not paths and not source_dir:
        raise ValueError("no files given: name paths or a source directory")
    listing = None
    if paths:
        named = sorted({literal_path(path) for path in paths})
        rows = spark.read.format("binaryFile").load(named)
        listing = _file_columns(rows).unionByName(_empty_files(spark, sorted(set(paths))))
    if source_dir:
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(literal_path(source_dir))
        in_dir = _file_columns(rows).unionByName(_empty_files(spark, [source_dir]))
        listing = in_dir if listing is None else listing.unionByName(in_dir).dropDuplicates(["file_path"])
    numbered = _ordinals(choose_files(listing, paths, source_dir, suffix))
    target = shared_dir(spark, "listing")
    numbered.write.parquet(target)
    numbered = spark.read.parquet(target)
    if paths:
        keys = spark.createDataFrame([(_path_key_of(path), path) for path in paths], "_key string, path string")
        lost = keys.join(numbered.select(_path_key("file_path").alias("_key")), "_key", "left_anti").limit(3).collect()
        if lost:
            raise FileNotFoundError(f"no such file: {', '.join(row['path'] for row in lost)}")
    return numbered


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that file listings take for wildcards."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def choose_files(
    listing: DataFrame, paths: list[str] | None = None, source_dir: str | None = None, suffix: str = "pdf"
) -> DataFrame:
    """The rows of a listing that a load takes, with ``given``: the place among ``paths``, null for others.

    A path named twice is two rows, as every named path gets its own load result. Of
    ``source_dir`` its direct children with the suffix, in any case. Load order is given
    paths by their place, then the others by path.
    """
    spark, key = listing.sparkSession, _path_key("file_path")
    chosen = []
    if paths:
        given = spark.createDataFrame([(_path_key_of(path), i) for i, path in enumerate(paths)], "_key string, given int")
        chosen.append(listing.withColumn("_key", key).join(given, "_key").drop("_key"))
    if source_dir:
        folder = F.lit(_path_key_of(source_dir).rstrip("/") + "/")
        child = F.startswith(key, folder) & ~F.contains(F.substr(key, F.length(folder) + 1), F.lit("/"))
        fits = mime.file_extension(F.col("file_name")) == suffix.lower()
        chosen.append(listing.where(child & fits).withColumn("given", F.lit(None).cast("int")))
    return chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])


def _path_key_of(path: str) -> str:
    """A path without its scheme: what a given path has in common with its listed form."""
    scheme, found, rest = path.partition("://")
    if found:
        return "/" + rest.lstrip("/")
    return os.path.abspath("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _path_key(column: str) -> Column:
    return F.concat(F.lit("/"), F.regexp_replace(F.col(column), r"^(?:[A-Za-z0-9]+:)?/*", ""))


def _empty_files(spark: SparkSession, places: list[str]) -> DataFrame:
    """Files without bytes among these paths or directories: Spark's file sources pass over them."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for place in batch.column("place").to_pylist():
                uri = place if "://" in place or place.startswith("file:") else os.path.abspath(place)
                system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                here = system.get_file_info(path)
                infos = [here] if here.is_file else system.get_file_info(fs.FileSelector(path))
                empty = [i for i in infos if i.is_file and i.size == 0]
                head = uri[: uri.index("://") + 3] if "://" in uri else "file:"
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([head + i.path for i in empty], pa.string()),
                        pa.array([i.mtime for i in empty], pa.timestamp("us", "UTC")),
                        pa.array([0 for _ in empty], pa.int64()),
                    ],
                    names=["path", "modificationTime", "length"],
                )

    listed = spark.createDataFrame([(p,) for p in places], "place string")
    return _file_columns(listed.mapInArrow(found, "path string, modificationTime timestamp, length long"))


def _file_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("path").alias("file_path"),
        mime.file_name(F.col("path")).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("file_modified_at"),
    )


def _ordinals(files: DataFrame) -> DataFrame:
    """Number the files in load order by a distributed sort.

    ``row_number`` over the whole listing would send all of it to one task. The id grows
    along the sorted partitions, which is all an ordinal needs; it may skip numbers.
    """
    key = [F.col("given").isNull(), F.col("given"), F.col("file_path")]
    return (
        files.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select(
            F.monotonically_increasing_id().alias("ordinal"),
            "file_path", "file_name", "file_size_bytes", "file_modified_at",
        )
    )


def file_attributes(files: DataFrame) -> DataFrame:
    """Name, path, extension, size and modification time of each file."""
    return files.select(
        "ordinal", "file_name", "file_path",
        mime.file_extension(F.col("file_name")).alias("file_extension"),
        "file_size_bytes", "file_modified_at",
    )


HASHED = T.StructType([
    T.StructField("sha256_hex", T.StringType()), T.StructField("head", T.BinaryType()), T.StructField("error", T.StringType())
])


def with_hash(files: DataFrame, opener: Callable[[str], BinaryIO] = open_uri) -> DataFrame:
    """Add ``sha256_hex``, ``head`` (first bytes) and ``error``, null where the file could be read.

    Bytes in a column are hashed by the engine's own ``sha2``. Files named by path are spread
    over the tasks by the bytes to read and read there as streams of blocks, so their size has
    no limit. A file that cannot be read has an error and no hash; the others go on.
    """
    if "content" in files.columns:
        return files.withColumns({
            "sha256_hex": identity.sha256_hex(F.col("content")),
            "head": F.substring("content", 1, HEAD_BYTES),
            "error": F.lit(None).cast("string"),
        })

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, heads, errors = [], [], []
            for uri in batch.column("file_path").to_pylist():
                digest, head, error = hashlib.sha256(), b"", None
                try:
                    with opener(uri) as stream:
                        while block := stream.read(READ_BLOCK_BYTES):
                            head = head or bytes(block[:HEAD_BYTES])
                            digest.update(block)
                except Exception as exc:
                    error = f"{type(exc).__name__}: {exc}"
                digests.append(None if error else digest.hexdigest())
                heads.append(None if error else head)
                errors.append(error)
            table = pa.table(batch).append_column("sha256_hex", pa.array(digests, pa.string()))
            table = table.append_column("head", pa.array(heads, pa.binary()))
            yield from table.append_column("error", pa.array(errors, pa.string())).to_batches()

    # A listing is a few bytes a file, so neither its size nor AQE tells how much there is to read.
    spread_out = files.repartition(task_count(files), "file_path")
    return spread_out.mapInArrow(hashed, T.StructType(files.schema.fields + HASHED.fields))


def with_identity(files: DataFrame) -> DataFrame:
    """Add ``document_id``, extension and media type to hashed files."""
    return (
        files.withColumn("document_id", identity.document_id(F.col("sha256_hex")))
        .withColumn("file_extension", mime.file_extension(F.col("file_name")))
        .withColumn("mime_type", mime.mime_type(F.col("file_name"), F.col("head")))
    )


def inspect_files(
    files: DataFrame,
    inspector: Callable[[BinaryIO, str], dict],
    opener: Callable[[str], BinaryIO] = open_uri,
) -> DataFrame:
    """Run a document-information plug-in per file and normalise what it reports.

    The plug-in gets an open file and its name and returns values for ``schemas.FILE_INFO``.
    Empty strings become NULL, dates are parsed, a file is encrypted when a method is named.
    A file whose plug-in fails has its message in ``error``; rows with an error stay as they are.
    """
    has_content = "content" in files.columns
    if "error" not in files.columns:
        files = files.withColumn("error", F.lit(None).cast("string"))
    kept = [f for f in files.schema.fields if f.name not in ("content", "error")]
    names = FILE_INFO.fieldNames()

    def inspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(FILE_INFO)
        for batch in batches:
            found, errors = [], batch.column("error").to_pylist()
            for i in range(batch.num_rows):
                name, info = batch.column("file_name")[i].as_py(), {}
                if errors[i] is None:
                    try:
                        with _open_row(batch, i, has_content, opener) as stream:
                            info = inspector(stream, name)
                    except Exception as exc:
                        errors[i] = f"{type(exc).__name__}: {exc}"
                found.append({key: info.get(key) for key in names})
            info = pa.Table.from_pylist(found, schema=arrow)
            table = pa.table(batch).select([f.name for f in kept])
            for key in names:
                table = table.append_column(key, info.column(key))
            yield from table.append_column("error", pa.array(errors, pa.string())).to_batches()

    raw = files.mapInArrow(inspected, T.StructType([*kept, *FILE_INFO.fields, T.StructField("error", T.StringType())]))
    return normalise_info(raw)


def normalise_info(raw: DataFrame) -> DataFrame:
    texts = ["pdf_format", "title", "author", "subject", "keywords", "creator", "producer", "encryption_method"]
    out = raw.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})
    nothing = F.array().cast("array<string>")
    return out.withColumns({
        "pdf_created_at": parse_pdf_date(F.col("created_raw")),
        "pdf_modified_at": parse_pdf_date(F.col("modified_raw")),
        "is_encrypted": F.col("encryption_method").isNotNull(),
        "needs_password": F.coalesce("needs_password", F.lit(False)),
        "layer_names": F.coalesce("layer_names", nothing),
        "hidden_layer_names": F.coalesce("hidden_layer_names", nothing),
    }).drop("created_raw", "modified_raw")


def _open_row(batch: pa.RecordBatch, i: int, has_content: bool, opener: Callable[[str], BinaryIO]) -> BinaryIO:
    if has_content:
        return pa.BufferReader(batch.column("content")[i].as_buffer())
    return opener(batch.column("file_path")[i].as_py())


def hidden_layer_documents(documents: DataFrame) -> DataFrame:
    """One row per layer that is off by default."""
    return documents.where(F.size("hidden_layer_names") > 0).select(
        "document_id", "file_name", F.explode("hidden_layer_names").alias("layer_name")
    )


CHUNK_RANGES = "document_id string, chunk_index int, byte_offset long, chunk_length_bytes int, content binary"


def read_chunks(
    files: DataFrame,
    chunk_bytes: int = DEFAULT_CHUNK_BYTES,
    opener: Callable[[str], BinaryIO] = open_uri,
) -> DataFrame:
    """Chunks of files named by path. Byte ranges, not files, are the unit of work.

    The list of ranges is spread over all tasks, so one huge file is read in parallel and a
    task holds one chunk at a time.
    """
    size = F.lit(check_chunk_size(chunk_bytes)).cast("long")
    ranges = (
        files.where(F.col("file_size_bytes") > 0)
        .select(
            "document_id", "file_path", "file_size_bytes",
            F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("file_size_bytes") - 1) / size)))
            .alias("chunk_index"),
        )
        .withColumn("byte_offset", F.col("chunk_index") * size)
    )

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, stream = None, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["file_path"] != uri:
                        if stream is not None:
                            stream.close()
                        uri = row["file_path"]
                        stream = opener(uri)
                    stream.seek(row["byte_offset"])
                    wanted = min(chunk_bytes, row["file_size_bytes"] - row["byte_offset"])
                    block = stream.read(wanted)
                    if len(block) != wanted:
                        raise OSError(f"{uri} is shorter than when it was listed")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["document_id"]], pa.string()),
                            pa.array([row["chunk_index"]], pa.int32()),
                            pa.array([row["byte_offset"]], pa.int64()),
                            pa.array([len(block)], pa.int32()),
                            pa.array([block], pa.binary()),
                        ],
                        names=["document_id", "chunk_index", "byte_offset", "chunk_length_bytes", "content"],
                    )
        finally:
            if stream is not None:
                stream.close()

    spread_out = ranges.repartition(
        task_count(files), "document_id", "chunk_index"
    ).sortWithinPartitions("file_path", "chunk_index")
    return spread_out.mapInArrow(fetched, CHUNK_RANGES)


def task_count(files: DataFrame) -> int:
    """Tasks for reading these files: about half a gigabyte each, and one per core at least.

    The rows to shuffle are tiny, so neither their size nor AQE could tell.
    """
    total = files.agg(F.sum("file_size_bytes")).first()[0] or 0
    return max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
