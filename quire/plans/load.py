"""Load files into a store: identify, decide, extract, write, commit, report."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import __version__, schemas
from quire.operators import loading, ocr
from quire.operators.checks import conform
from quire.operators.chunks import DEFAULT_CHUNK_BYTES, check_chunk_size, cut_chunks, tree_roots, with_digest
from quire.plans.store import CHUNKS, DOCUMENTS, PAGES, RETIRED, TABLES, PageStore
from quire.session import shared_dir, spread
from quire.sources import files as sources
from quire.sources.extract import TEXT, Plugin, failures, file_seconds, good_pages, pages_of_text, raw_pages


@dataclass(frozen=True)
class LoadOptions:
    """``page_chars``: text in a ``content`` column is cut by expressions into pages of so many
    characters (0: at form feeds). None: ``plugin`` reads the files. ``ocr_engine`` gets
    ``ocr_payload`` columns of each blank page with images; ``ocr_files`` is an engine that works on opened
    files instead. None of both leaves such pages blank."""

    chunk_bytes: int = DEFAULT_CHUNK_BYTES
    replace: bool = False
    reveal_hidden_layers: bool = False
    max_pages: int | None = None
    page_chars: int | None = None
    plugin: Plugin = TEXT
    ocr_engine: Callable[[dict], str] | None = None
    ocr_payload: tuple[str, ...] = ("file_path", "page_number")
    ocr_files: ocr.FileEngine | None = None
    opener: Callable[[str], BinaryIO] = sources.open_uri


def describe_files(files: DataFrame, options: LoadOptions) -> DataFrame:
    """File rows with hash, ids, media type and document information; without their bytes."""
    if options.page_chars is not None and "content" not in files.columns:
        raise ValueError("page_chars cuts text in a content column; files named by path need a plug-in")
    hashed = sources.with_identity(sources.with_hash(files, options.opener))
    if options.page_chars is None and options.plugin.inspect:
        described = sources.inspect_files(hashed, options.plugin.inspect, options.opener)
    else:
        blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.FILE_INFO.fields}
        described = sources.normalise_info(hashed.withColumns(blank))
        if options.page_chars is not None:
            body = F.decode("content", "UTF-8")
            if options.page_chars:
                count = F.ceil(F.char_length(body) / options.page_chars)
            else:
                count = F.char_length(body) - F.char_length(F.translate(body, "\f", "")) + 1
            described = described.withColumn("page_count", count.cast("int"))
    return described.drop("content", "head")


def _extract(
    files: DataFrame, about: DataFrame, options: LoadOptions, staging: str
) -> tuple[DataFrame, DataFrame | None]:
    """Pages of the files, recognised text included, and (document_id, error) of the files that failed.

    ``about`` has what an OCR engine may be told of a document. A plug-in's rows are written to
    ``staging`` first, so that it runs once.
    """
    spark, failed = files.sparkSession, None
    if options.page_chars is not None:
        pages = pages_of_text(files, options.page_chars or None, options.max_pages)
    else:
        raw = raw_pages(files, options.plugin, options.max_pages, options.reveal_hidden_layers, options.opener)
        raw.write.parquet(f"{staging}/raw_pages")
        raw = spark.read.parquet(f"{staging}/raw_pages")
        failures(raw).write.parquet(f"{staging}/failed")
        failed = spark.read.parquet(f"{staging}/failed")
        pages = good_pages(raw, failed)
    if options.ocr_engine:
        pages.write.parquet(f"{staging}/pages")
        pages = spark.read.parquet(f"{staging}/pages")
        extra = [c for c in options.ocr_payload if c not in pages.columns]
        wanted = ocr.ocr_candidates(pages)
        if extra:
            wanted = wanted.join(about.select("document_id", *extra), "document_id")
        pages = ocr.merge_ocr(pages, ocr.run_ocr(wanted, options.ocr_engine, list(options.ocr_payload)))
    elif options.ocr_files:
        pages.write.parquet(f"{staging}/pages")
        pages = spark.read.parquet(f"{staging}/pages")
        wanted = ocr.ocr_candidates(pages).join(about.select("document_id", "file_path", "file_size_bytes", "page_count"), "document_id")
        bytes_a_page = F.col("file_size_bytes") / F.greatest(F.coalesce("page_count", F.lit(1)), F.lit(1))
        pages = ocr.merge_ocr(pages, ocr.run_ocr_files(wanted, options.ocr_files, weight=bytes_a_page))
    return pages, failed


def load_files(store: PageStore, files: DataFrame, options: LoadOptions = LoadOptions()) -> DataFrame:
    """Load file rows; returns the report, one row per input file.

    Bytes stored already are skipped before anything is extracted, or with ``replace`` loaded
    anew. A file that cannot be read or extracted costs only itself: it is reported as
    ``failed`` with its error, and what the store had of it stays. Documents are written last,
    which commits the load; a load that breaks off before leaves nothing behind. What later
    steps need is written to the store's own folder, so the loss of an executor never repeats a
    decision with a different outcome.
    """
    check_chunk_size(options.chunk_bytes)
    spark, started = store.spark, time.monotonic()
    load_id = store.new_load_id()
    staging = f"{store.root}/staging/load_id={load_id}"
    if "content" in files.columns:
        files = spread(files)
    try:
        describe_files(files, options).write.parquet(f"{staging}/files")
        staged = spark.read.parquet(f"{staging}/files")
        chosen = loading.files_to_load(staged.where("error IS NULL"), store.documents(), options.replace)
        chosen.write.parquet(f"{staging}/chosen")
        chosen = spark.read.parquet(f"{staging}/chosen")
        loaded, failed = _write_load(store, load_id, staging, files, chosen, options)
        report = loading.load_report(staged, loaded, options.replace, failed)
        target = f"{store.root}/reports/{load_id}"
        report.withColumn("load_seconds", F.lit(time.monotonic() - started)).write.parquet(target)
        if loaded.isEmpty():
            store.discard(load_id)
        else:
            store.write(DOCUMENTS, conform(loaded, TABLES[DOCUMENTS]), load_id)
    except Exception:
        store.discard(load_id)
        raise
    store.discard_staging(load_id)
    return spark.read.parquet(target)


def _write_load(store, load_id, staging, files, chosen, options) -> tuple[DataFrame, DataFrame | None]:
    """Write all rows of one load but its documents; returns these, and the files that failed."""
    spark = store.spark
    if chosen.isEmpty():
        return _rolled(chosen, store.pages().limit(0), store.table(CHUNKS).limit(0), options), None
    source = chosen
    if "content" in files.columns:
        source = loading.chosen_content(files, spark.read.parquet(f"{staging}/files"), chosen)

    pages, failed = _extract(source, chosen, options, staging)
    if failed is not None:
        chosen, source = (rows.join(failed, "document_id", "left_anti") for rows in (chosen, source))
    if "content" in files.columns:
        chunks = cut_chunks(source, options.chunk_bytes)
    else:
        chunks = sources.read_chunks(source, options.chunk_bytes, options.opener)
    pages, chunks = conform(pages, schemas.PAGES), with_digest(conform(chunks, schemas.CHUNKS))
    # Two jobs that share nothing: one fills the cores that the other's last tasks leave idle.
    with ThreadPoolExecutor(2) as pool:
        both = (
            pool.submit(store.write, PAGES, pages, load_id),
            pool.submit(store.write, CHUNKS, chunks, load_id, options.chunk_bytes),
        )
        stored_pages, stored_chunks = (job.result() for job in both)

    rolled = _rolled(chosen, stored_pages, stored_chunks, options)
    if failed is not None:  # a plug-in ran
        seconds = file_seconds(spark.read.parquet(f"{staging}/raw_pages"))
        rolled = rolled.drop("extract_seconds").join(seconds, "document_id", "left")
    rolled.write.parquet(f"{staging}/rolled")
    rolled = spark.read.parquet(f"{staging}/rolled")
    if options.replace:
        store.write(RETIRED, rolled.where("replaces").select("document_id"), load_id)
    return rolled, failed


def _rolled(chosen: DataFrame, pages: DataFrame, chunks: DataFrame, options: LoadOptions) -> DataFrame:
    """Document rows of the chosen files, with the root over the digests of their chunks."""
    rolled = loading.roll_up(chosen, pages, chunks).join(tree_roots(chunks), "document_id", "left")
    return rolled.withColumns({
        "extract_seconds": F.lit(None).cast("double"),
        "hidden_layers_revealed": F.lit(options.reveal_hidden_layers) & (F.size("hidden_layer_names") > 0),
        "chunk_size_bytes": F.lit(options.chunk_bytes),
        "page_count": F.coalesce("page_count", "pages_extracted"),
        "loaded_at": F.current_timestamp(),
        "loaded_by": F.current_user(),
        "loader_version": F.lit(__version__),
    })


def load_and_index(
    store: PageStore, files: DataFrame, options: LoadOptions = LoadOptions(), **index: object
) -> DataFrame:
    """Load, then add what was loaded to the index as a segment; ``index`` goes to ``update_index``."""
    report = load_files(store, files, options)
    store.update_index(**index)
    return report


def dry_run(files: DataFrame, options: LoadOptions = LoadOptions()) -> DataFrame:
    """What a load would find in each input file, text recognition included; nothing is stored.

    The described files are written to the shared folder and extracted from there, so that both
    halves of the answer speak of the same numbered files.
    """
    staging = shared_dir(files.sparkSession, "dry-run")
    if "content" in files.columns:
        files = spread(files)
    describe_files(files, options).write.parquet(f"{staging}/files")
    described = files.sparkSession.read.parquet(f"{staging}/files")
    named = F.col("ordinal").cast("string")
    about = described.withColumn("document_id", named)
    source = files.withColumn("document_id", named) if "content" in files.columns else about
    pages, failed = _extract(source, about, options, staging)
    return loading.dry_run(described, pages, failed, options.reveal_hidden_layers)
