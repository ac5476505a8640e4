"""Whole-document text, substring search and the plain listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text

# Pages joined per intermediate piece of a document's text.
SEGMENT_PAGES = 256


def document_text(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per document with pages: its pages in order, joined with form feeds.

    Two levels: runs of ``SEGMENT_PAGES`` pages first, spread by (document, run), then the few
    runs of each document. A document with very many pages is thus built by many tasks; its
    final value is one cell, which the engine limits to 2 GiB (see ``document_text_segments``).
    """
    segments = document_text_segments(pages)
    joined = segments.groupBy("document_id").agg(
        F.expr(r"listagg(segment_text, chr(12)) WITHIN GROUP (ORDER BY segment)").alias("document_text")
    )
    heads = documents.select("document_id", "file_name", "title", "page_count")
    return heads.join(joined, "document_id").select(
        "document_id", "file_name", "title", "page_count", "document_text"
    )


def document_text_segments(pages: DataFrame) -> DataFrame:
    """Document text in runs of ``SEGMENT_PAGES`` pages, for documents too long for one cell."""
    segment = F.floor((F.col("page_number") - 1) / SEGMENT_PAGES).alias("segment")
    return pages.groupBy("document_id", segment).agg(
        F.expr(r"listagg(page_text, chr(12)) WITHIN GROUP (ORDER BY page_number)").alias("segment_text")
    )


def search_pages(
    documents: DataFrame, pages: DataFrame, term: str | None, limit: int | None = None
) -> DataFrame:
    """Pages that contain the term in any case, with a snippet around the first hit.

    The filter and the snippet come before the join, so only the hits' snippets are moved.
    With ``limit`` the plan is a top-k and not a full sort.
    """
    hits = pages.where(text.contains_term(F.col("page_text"), term)).select(
        "document_id", "page_number", "page_label",
        text.snippet_around(F.col("page_text"), term).alias("snippet"),
    )
    found = (
        hits.join(documents.select("document_id", "file_name"), "document_id")
        .orderBy("file_name", "page_number", "document_id")
        .select("file_name", "page_number", "page_label", "snippet", "document_id")
    )
    return found if limit is None else found.limit(limit)


# ``search_pages`` for SQL: the same filter and snippet, by views of the store.
SEARCH_PAGES_SQL = r"""
CREATE OR REPLACE TEMPORARY FUNCTION {prefix}search_pages(term STRING)
RETURNS TABLE (file_name STRING, page_number INT, page_label STRING, snippet STRING, document_id STRING)
RETURN SELECT d.file_name, p.page_number, p.page_label,
    substr(p.page_text, greatest(1, instr(lower(p.page_text), lower(search_pages.term)) - {lead}), {chars}), p.document_id
  FROM {prefix}document_pages p JOIN {prefix}documents d ON d.document_id = p.document_id
  WHERE p.page_text ILIKE concat('%', replace(search_pages.term, chr(92), chr(92) || chr(92)), '%')
""".replace("{lead}", str(text.SNIPPET_LEAD)).replace("{chars}", str(text.SNIPPET_CHARS)).replace("search_pages.term", "{prefix}search_pages.term")


def squeeze_snippets(hits: DataFrame) -> DataFrame:
    """Hits as shown to a reader: white space in snippets squeezed to single blanks."""
    return hits.withColumn("snippet", text.squeeze(F.col("snippet")))


def list_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        "file_name", "file_size_bytes", "page_count", "pages_with_text", "total_text_chars",
        "chunk_count", "hidden_layers_revealed", "loaded_at", "document_id",
    ).orderBy("file_name", "document_id")


def document_metadata(documents: DataFrame) -> DataFrame:
    return documents.select(
        "file_name", "mime_type", "file_size_bytes", "page_count", "pages_with_text",
        "title", "producer", "pdf_created_at",
    )
