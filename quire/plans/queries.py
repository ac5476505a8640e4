"""The registered queries: every operator over the whole given tables.

Most run on a store that is loaded from ``documents`` once per application and kept in the
shared folder, just as a user would load once and then query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import identity, mime
from quire.functions.pdf_dates import parse_pdf_date
from quire.operators import chunks, loading, ocr, ranking, search
from quire.operators.checks import not_null_violations
from quire.plans.load import LoadOptions, dry_run, load_files
from quire.plans.store import CHUNKS as CHUNK_ROWS
from quire.plans.store import DOCUMENTS as DOCUMENT_ROWS
from quire.plans.store import PageStore
from quire.schemas import CHUNKS, DOCUMENTS, PAGES, required
from quire.session import shared_dir, ship_package, spread
from quire.sources import adapters, files
from quire.sources.extract import HTML, Plugin, extract_pages, first_pages

CHUNK_BYTES = 4096
OPTIONS = LoadOptions(chunk_bytes=CHUNK_BYTES, page_chars=adapters.PAGE_CHARS)

SUBSTRING = "License"
WILDCARD = "un_er%licen_e"
RANKED = "mit license software"
ALL_TERMS = "the and of that"
STEMMED = "licensing warranties"
STOP_WORDS = ("the", "and", "of", "de", "la")

_STORES: dict[tuple[str, str, str], PageStore] = {}


def _store(spark: SparkSession, sf_dir: str, kind: str, prepare: Callable[[PageStore], None]) -> PageStore:
    """The store of this kind for these tables, prepared on first use in the application."""
    ship_package(spark)
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _STORES:
        store = PageStore(spark, shared_dir(spark, f"store-{kind}"))
        prepare(store)
        _STORES[key] = store
    return _STORES[key]


def _micros(column: str) -> F.Column:
    return F.unix_micros(column).alias(column.removesuffix("_at") + "_us")


# --- stores -----------------------------------------------------------------------------


def loaded_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """All documents loaded once."""
    return _store(
        spark, sf_dir, "loaded",
        lambda store: load_files(store, adapters.file_rows(spark, sf_dir), OPTIONS),
    )


def indexed_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """The loaded store with a plain index (no stemming, no stop words)."""
    store = loaded_store(spark, sf_dir)
    _store(spark, sf_dir, "indexed", lambda _: store.build_index(stemmer=None, stop_words=None))
    return store


def stemmed_store(spark: SparkSession, sf_dir: str) -> tuple[PageStore, str]:
    """The loaded store with an index elsewhere: stemmed, some stop words left out, over a copy."""
    store = loaded_store(spark, sf_dir)
    location = f"{store.root}-stemmed-index"
    _store(
        spark, sf_dir, "stemmed",
        lambda _: store.build_index(location=location, stemmer="english", stop_words=list(STOP_WORDS)),
    )
    return store, location


def replaced_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """Loaded, then loaded again with ``replace``."""

    def prepare(store: PageStore) -> None:
        load_files(store, adapters.file_rows(spark, sf_dir), OPTIONS)
        load_files(store, adapters.file_rows(spark, sf_dir), LoadOptions(
            chunk_bytes=CHUNK_BYTES, page_chars=adapters.PAGE_CHARS, replace=True
        ))

    return _store(spark, sf_dir, "replaced", prepare)


def reduced_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """Loaded and indexed; then every French document deleted, so the index is stale."""

    def prepare(store: PageStore) -> None:
        load_files(store, adapters.file_rows(spark, sf_dir), OPTIONS)
        store.build_index(stemmer=None, stop_words=None)
        french = adapters.table(spark, sf_dir, "documents").where("lang = 'fr'")
        ids = french.select(identity.document_id(F.sha2("text", 256)).alias("document_id"))
        store.delete_documents(ids)

    return _store(spark, sf_dir, "reduced", prepare)


#: Loads that the store of segments comes from: one more than are merged.
PARTS = 5


def segmented_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """The documents in several loads, each indexed after it: one merged segment and a fresh one."""

    def prepare(store: PageStore) -> None:
        rows = adapters.file_rows(spark, sf_dir)
        most = rows.agg(F.max("ordinal")).first()[0]
        # Plain bounds reach the scan, so a load skips the row groups of the others.
        bounds = [-(-(most + 1) * number // PARTS) for number in range(PARTS + 1)]
        for low, high in zip(bounds, bounds[1:]):
            load_files(store, rows.where((F.col("ordinal") >= low) & (F.col("ordinal") < high)), OPTIONS)
            store.update_index(stemmer=None, stop_words=None)

    return _store(spark, sf_dir, "segmented", prepare)


def streamed_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """The documents table picked up as a stream."""
    from quire.streaming.ingest import ingest

    def prepare(store: PageStore) -> None:
        schema = adapters.table(spark, sf_dir, "documents").schema
        # The table is one file or, if larger, a folder of files; the stream source takes both only by a pattern.
        stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
        rows = adapters.as_file_rows(stream)
        ingest(store, rows, f"{store.root}-checkpoint", OPTIONS, index={"stemmer": None, "stop_words": None}).awaitTermination()

    return _store(spark, sf_dir, "streamed", prepare)


# --- files ------------------------------------------------------------------------------


#: Paths named beforehand, one of them twice; the others come from the folder.
NAMED = ["/mixed/10.q9", "/mixed/1.PDF", "/mixed/2", "/mixed/10.q9"]


def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files of a listing a load takes: named paths first, then the folder's PDF files."""
    chosen = files.choose_files(adapters.mixed_file_rows(spark, sf_dir), NAMED, "/mixed", "pdf")
    return chosen.select("given", "file_path", "file_name", "file_size_bytes")


def file_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.file_attributes(adapters.file_rows(spark, sf_dir))
    return rows.select(
        "ordinal", "file_name", "file_path", "file_extension", "file_size_bytes", _micros("file_modified_at")
    )


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.with_hash(adapters.file_rows(spark, sf_dir)).select("ordinal", "sha256_hex")


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = files.with_hash(adapters.file_rows(spark, sf_dir))
    return hashed.select("ordinal", identity.document_id(F.col("sha256_hex")).alias("document_id"))


def mime_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.mixed_file_rows(spark, sf_dir)
    return rows.select(
        "ordinal", "file_name",
        mime.file_extension(F.col("file_name")).alias("file_extension"),
        mime.mime_type(F.col("file_name"), F.col("content")).alias("mime_type"),
    )


def pdf_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.pdf_dates(spark, sf_dir)
    return rows.select("date_id", "raw", F.unix_micros(parse_pdf_date(F.col("raw"))).alias("parsed_us"))


def document_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = spread(adapters.html_rows(spark, sf_dir))
    return files.inspect_files(rows, HTML.inspect).select(
        "ordinal", "file_name", "page_count", "pdf_format", "title", "author", "is_encrypted", "needs_password"
    )


def _characters(stream, wanted):
    """A plug-in for UTF-8 text that counts characters to a page."""
    size = adapters.PAGE_CHARS
    body = bytes(stream.read()).decode("utf-8")
    for number, start in enumerate(range(0, len(body), size), start=1):
        if number in wanted:
            yield {"page_number": number, "page_text": body[start:start + size]}


def extracted_pages(spark: SparkSession, sf_dir: str, max_pages: int | None = None) -> DataFrame:
    """Pages by a Python plug-in in Arrow batches."""
    ship_package(spark)
    rows = spread(adapters.file_rows(spark, sf_dir)).withColumn("document_id", F.col("ordinal").cast("string"))
    return extract_pages(rows, Plugin(_characters), max_pages).select(
        F.col("document_id").cast("long").alias("ordinal"),
        "page_number", "extraction_method", "char_count", "page_text",
    )


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = spread(adapters.html_rows(spark, sf_dir)).withColumn("document_id", F.col("ordinal").cast("string"))
    return extract_pages(rows, HTML).select(
        F.col("document_id").cast("long").alias("ordinal"), "page_number", "extraction_method", "page_text"
    )


def max_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_pages(adapters.page_rows(spark, sf_dir), 2).select("page_id", "page_number", "page_text")


def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.page_rows(spark, sf_dir).select(
        "document_id", "page_number", "page_id", "extraction_method", "char_count"
    )


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    out = None
    for name, rows, schema in (
        ("documents", store.documents(), DOCUMENTS),
        ("document_chunks", store.chunks(), CHUNKS),
        ("document_pages", store.pages(), PAGES),
    ):
        counted = not_null_violations(rows, required(schema)).select(F.lit(name).alias("table_name"), "*")
        out = counted if out is None else out.unionByName(counted)
    return out


def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column of the documents with their labels, which many of them lack."""
    labels = adapters.table(spark, sf_dir, "labels")
    rows = adapters.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return not_null_violations(rows, ["doc_id", "text", "lang", "quality", "toxic"])


# --- text recognition ---------------------------------------------------------------------


def ocr_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = adapters.ocr_page_rows(spark, sf_dir)
    return ocr.ocr_candidates(pages).select("document_id", "page_number", "image_count")


def _read_scan(payload: dict) -> str:
    return bytes(payload["scan"]).decode("utf-8")


def ocr_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognise the candidates (their scans hold the text) and merge the results."""
    ship_package(spark)
    pages = adapters.ocr_page_rows(spark, sf_dir)
    found = ocr.run_ocr(ocr.ocr_candidates(pages), _read_scan, ["scan"])
    return ocr.merge_ocr(pages, found).select(
        "document_id", "page_number", "extraction_method", "char_count", "page_text"
    )


# --- chunks -------------------------------------------------------------------------------


def chunk_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).chunks().select(
        "document_id", "chunk_index", "byte_offset", "chunk_length_bytes", F.hex("content").alias("content_hex")
    )


def chunk_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    return chunks.fetch_chunks(store.chunks(), store.documents(), "3.txt").select(
        "document_id", "chunk_index", F.hex("content").alias("content_hex")
    )


def chunk_fetch_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of the longest file, in order."""
    store = loaded_store(spark, sf_dir)
    longest = store.documents().orderBy(F.desc("file_size_bytes"), "file_name").first().file_name
    return chunks.fetch_chunks(store.chunks(), store.documents(), longest).select(
        "document_id", "chunk_index", F.sha2("content", 256).alias("content_sha256")
    )


def sql_document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded_store(spark, sf_dir).register_sql("store_")
    return spark.sql("SELECT document_id, file_name, sha2(document_text, 256) AS text_sha256 FROM store_document_text")


def sql_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded_store(spark, sf_dir).register_sql("store_")
    return spark.sql(f"SELECT * FROM store_search_pages('{WILDCARD}')")


def chunk_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    return chunks.verify_chunks(store.chunks(), store.documents())


def chunk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification by the digests of chunks, in place."""
    store = loaded_store(spark, sf_dir)
    found = chunks.verify_tree(store.table(CHUNK_ROWS), store.table(DOCUMENT_ROWS))
    return found.withColumn("damaged_chunks", F.array_join(F.col("damaged_chunks").cast("array<string>"), ","))


def chunk_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    return chunks.chunk_gaps(store.chunks(), store.documents())


def chunk_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_order(loaded_store(spark, sf_dir).chunks())


# --- loading ------------------------------------------------------------------------------


def migrate_page_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = loaded_store(spark, sf_dir).pages().drop("page_id")
    return loading.migrate_page_id(old).select("document_id", "page_number", "page_id")


def already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files a second load would find stored, once the French ones were deleted."""
    hashed = files.with_hash(adapters.file_rows(spark, sf_dir)).select("ordinal", "file_path", "sha256_hex")
    return loading.already_loaded(hashed, reduced_store(spark, sf_dir).documents())


def load_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of all files would still have to load, once the French ones were deleted."""
    described = files.with_identity(files.with_hash(adapters.file_rows(spark, sf_dir))).drop("content", "head")
    stored = reduced_store(spark, sf_dir).documents()
    return loading.files_to_load(described, stored).select("ordinal", "file_path", "sha256_hex", "document_id")


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = replaced_store(spark, sf_dir)
    pages = store.pages().groupBy("document_id").agg(F.count("*").alias("live_pages"))
    return store.documents().join(pages, "document_id", "left").select(
        "document_id", "file_name", "file_path", "chunk_count", F.coalesce("live_pages", F.lit(0)).alias("live_pages")
    )


def delete_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_counts(reduced_store(spark, sf_dir))


def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_counts(loaded_store(spark, sf_dir))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_counts(streamed_store(spark, sf_dir))


def _table_counts(store: PageStore) -> DataFrame:
    """Per document: size, pages, characters, chunks and bytes that are live."""
    pages = store.pages().groupBy("document_id").agg(
        F.count("*").alias("live_pages"), F.sum("char_count").alias("live_chars")
    )
    pieces = store.chunks().groupBy("document_id").agg(
        F.count("*").alias("live_chunks"), F.sum("chunk_length_bytes").alias("live_bytes")
    )
    documents = store.documents().select("document_id", "file_name", "file_size_bytes")
    joined = documents.join(pages, "document_id", "full").join(pieces, "document_id", "full")
    return joined.select(
        "document_id", "file_name", "file_size_bytes", "live_pages", "live_chars", "live_chunks", "live_bytes"
    )


def document_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).documents().select(
        "document_id", "file_name", "file_size_bytes", "sha256_hex", "mime_type", "page_count",
        "chunk_count", "pages_with_text", "pages_ocr", "total_text_chars",
    )


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the first load of all files."""
    store = loaded_store(spark, sf_dir)
    first = store.snapshot().loads[0]
    return spark.read.parquet(f"{store.root}/reports/{first}").drop("load_seconds", "extract_seconds", "error")


def replace_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a replacing load of all files."""
    store = replaced_store(spark, sf_dir)
    last = store.snapshot().loads[-1]
    return spark.read.parquet(f"{store.root}/reports/{last}").drop("load_seconds", "extract_seconds", "error")


def _damaged(stream, name: str) -> dict:
    if int(name.split(".")[0]) % 50 == 7:
        raise ValueError("damaged")
    return {}


def _unreadable(stream, wanted):
    text = stream.read().decode("utf-8")
    if "License" in text:
        raise ValueError("unreadable page")
    yield {"page_number": 1, "page_text": text}


def load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a load in which some files cannot be inspected and others not extracted."""
    ship_package(spark)
    store = PageStore(spark, shared_dir(spark, "store-failures"))
    report = load_files(store, adapters.file_rows(spark, sf_dir), LoadOptions(plugin=Plugin(_unreadable, _damaged)))
    return report.select("ordinal", "status", "error")


def dry_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dry_run(spread(adapters.file_rows(spark, sf_dir)), OPTIONS)
    return found.drop("hidden_layer_names", "revealed_layer_names", "error")


# --- listings and substring search ----------------------------------------------------------


def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.document_metadata(loaded_store(spark, sf_dir).documents()).withColumn(
        "pdf_created_us", F.unix_micros("pdf_created_at")
    ).drop("pdf_created_at")


def list_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).list_documents().drop("loaded_at")


def search_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).search_pages(SUBSTRING)


def search_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).search_pages(WILDCARD)


def gram_store(spark: SparkSession, sf_dir: str) -> PageStore:
    """The loaded store with its trigram index, in a session of queries once."""
    store = loaded_store(spark, sf_dir)
    _store(spark, sf_dir, "grams", lambda _: store.update_grams())
    return store


def search_substring_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring search that reads candidate pages only."""
    return gram_store(spark, sf_dir).search_pages(SUBSTRING)


def search_wildcard_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gram_store(spark, sf_dir).search_pages(WILDCARD)


def search_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 hits as shown to a reader."""
    return search.squeeze_snippets(loaded_store(spark, sf_dir).search_pages("the", limit=20))


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_store(spark, sf_dir).document_text()


# --- ranked search ---------------------------------------------------------------------------


def tokenize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = ranking.tokenize_pages(spread(adapters.page_rows(spark, sf_dir)))
    return cut.select("page_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = ranking.with_document_id(indexed_store(spark, sf_dir).index().postings)
    return postings.select(
        identity.page_id(F.col("document_id"), F.col("page_number")).alias("page_id"), "term", "tf", "page_len"
    )


def index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed_store(spark, sf_dir).index().terms.select("term", "df", "total_tf", "max_tf", "min_len")


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed_store(spark, sf_dir).index().stats.select(
        "n_pages", "n_terms", "n_tokens", F.round("avg_len", 6).alias("avg_len")
    )


def index_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of the page text that the index elsewhere was built over."""
    store, location = stemmed_store(spark, sf_dir)
    return store.index(location).pages.drop("segment")


def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed_store(spark, sf_dir).search_pages_ranked(RANKED)


def search_ranked_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indexed_store(spark, sf_dir).search_pages_ranked(ALL_TERMS, top_k=10, all_terms=True)
    return found.withColumn("score", F.round("score", 2))


def search_ranked_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, location = stemmed_store(spark, sf_dir)
    return store.search_pages_ranked(STEMMED, location=location)


def search_ranked_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = adapters.query_rows(spark, sf_dir)
    return indexed_store(spark, sf_dir).search_pages_ranked_batch(queries, top_k=10)


def index_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked search over an index that still holds deleted documents."""
    return reduced_store(spark, sf_dir).search_pages_ranked("la de license", top_k=30)


def search_ranked_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search over an index that grew load by load."""
    return segmented_store(spark, sf_dir).search_pages_ranked(RANKED)


def search_ranked_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search over what a stream loaded and indexed."""
    return streamed_store(spark, sf_dir).search_pages_ranked(RANKED)


def sql_search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked search by its SQL function."""
    indexed_store(spark, sf_dir).register_sql("ranked_")
    return spark.sql(f"SELECT * FROM ranked_search_pages_ranked('{RANKED}')")


def segment_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term statistics over the segments of the grown index."""
    return segmented_store(spark, sf_dir).index().terms.select("term", "df", "total_tf", "max_tf", "min_len")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "file_scan": file_scan,
        "file_attributes": file_attributes,
        "content_hash": content_hash,
        "document_ids": document_ids,
        "page_keys": page_keys,
        "mime_guess": mime_guess,
        "pdf_date_parse": pdf_date_parse,
        "document_info": document_info,
        "extract_pages": extracted_pages,
        "extract_pages_capped": partial(extracted_pages, max_pages=1),
        "html_pages": html_pages,
        "max_pages": max_pages,
        "not_null_violations": null_counts,
        "ocr_candidates": ocr_candidates,
        "ocr_merge": ocr_merge,
        "chunk_content": chunk_content,
        "chunk_fetch": chunk_fetch,
        "chunk_fetch_long": chunk_fetch_long,
        "null_rows": null_rows,
        "sql_document_text": sql_document_text,
        "sql_search_pages": sql_search_pages,
        "chunk_verify": chunk_verify,
        "chunk_gaps": chunk_gaps,
        "chunk_tree": chunk_tree,
        "chunk_order": chunk_order,
        "migrate_page_id": migrate_page_id,
        "already_loaded": already_loaded,
        "load_dedup": load_dedup,
        "load_replace": load_replace,
        "replace_report": replace_report,
        "delete_document": delete_document,
        "load_tables": load_tables,
        "document_rollup": document_rollup,
        "load_report": load_report,
        "load_failures": load_failures,
        "dry_run_summary": dry_run_summary,
        "stream_ingest": stream_ingest,
        "document_metadata": document_metadata,
        "list_documents": list_documents,
        "search_substring": search_substring,
        "search_wildcard": search_wildcard,
        "search_shown": search_shown,
        "search_substring_grams": search_substring_grams,
        "search_wildcard_grams": search_wildcard_grams,
        "document_text": document_text,
        "tokenize_pages": tokenize_pages,
        "index_postings": index_postings,
        "index_terms": index_terms,
        "index_stats": index_stats,
        "index_copy": index_copy,
        "search_ranked": search_ranked,
        "search_ranked_all_terms": search_ranked_all_terms,
        "search_ranked_stemmed": search_ranked_stemmed,
        "search_ranked_batch": search_ranked_batch,
        "index_staleness": index_staleness,
        "search_ranked_segments": search_ranked_segments,
        "search_ranked_streamed": search_ranked_streamed,
        "segment_terms": segment_terms,
        "sql_search_ranked": sql_search_ranked,
    }
