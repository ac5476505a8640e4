"""The given tables seen as files, pages, dates and queries (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import identity
from quire.functions.text import is_nonblank
from quire.session import spread
from quire.sources.extract import pages_of_text

PAGE_CHARS = 2000
# Modification times of the file rows: one minute apart from this moment on.
FIRST_MODIFIED = 1_700_000_000

# Endings of the mixed file rows, by doc_id modulo 7.
MIXED_ENDINGS = (".txt", ".PDF", "", ".q9", "", ".tgz", ".html.gz")

# Date strings with every optional part, and broken ones.
DATE_CASES = (
    "D:20250609143818+09'00'", "D:20240704151138-05'30'", "D:20240704151138Z", "D:2024",
    "", None, "not a date", "D:20241399",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_file_rows(documents: DataFrame) -> DataFrame:
    """Each text is the file ``/<source>/<doc_id>.txt``."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return documents.select(
        F.col("doc_id").alias("ordinal"),
        F.concat(F.lit("/"), F.col("source"), F.lit("/"), name).alias("file_path"),
        name.alias("file_name"),
        F.octet_length("text").cast("long").alias("file_size_bytes"),
        F.timestamp_seconds(F.lit(FIRST_MODIFIED) + F.col("doc_id") * 60).alias("file_modified_at"),
        F.encode("text", "UTF-8").alias("content"),
    )


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_file_rows(table(spark, sf_dir, "documents"))


def mixed_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File rows whose names and first bytes vary: known, unknown, packed and missing extensions."""
    marked = F.when(F.col("doc_id") % 7 == 4, F.concat(F.lit("%PDF-1.7 "), F.col("text")))
    rows = as_file_rows(
        table(spark, sf_dir, "documents").withColumn("text", F.coalesce(marked, F.col("text")))
    )
    endings = F.array(*[F.lit(e) for e in MIXED_ENDINGS])
    ending = F.element_at(endings, (F.col("ordinal") % 7 + 1).cast("int"))
    name = F.concat(F.col("ordinal").cast("string"), ending)
    return rows.withColumns({"file_name": name, "file_path": F.concat(F.lit("/mixed/"), name)})


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ``PAGE_CHARS`` characters of every text; the document id comes from the path."""
    files = spread(file_rows(spark, sf_dir)).withColumn(
        "document_id", identity.document_id(F.sha2("file_path", 256))
    )
    return pages_of_text(files, PAGE_CHARS)


def ocr_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_rows`` as if scanned: every seventh file has no text layer, files differ in images.

    ``scan`` holds the bytes that an engine would read.
    """
    files = spread(file_rows(spark, sf_dir)).withColumn(
        "document_id", identity.document_id(F.sha2("file_path", 256))
    )
    pages = pages_of_text(files, PAGE_CHARS).join(files.select("document_id", "ordinal"), "document_id")
    blank = F.col("ordinal") % 7 == 0
    seen = F.when(blank, F.lit("")).otherwise(F.col("page_text"))
    return pages.withColumn("scan", F.encode("page_text", "UTF-8")).withColumns({
        "page_text": seen,
        "image_count": (F.col("ordinal") % 3).cast("int"),
        "extraction_method": F.when(is_nonblank(seen), "native").otherwise("none"),
        "char_count": F.char_length(seen),
    })


def pdf_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date_id, raw): order dates in the document-information layout, and the fixed cases (negative ids)."""
    key = F.col("o_orderkey")
    zone = F.element_at(
        F.array(F.lit("Z"), F.lit("+09'00'"), F.lit("-05'30'"), F.lit("")), (key % 4 + 1).cast("int")
    )
    stamp = F.regexp_replace(F.substring(F.col("o_orderdate").cast("string"), 1, 19), "[^0-9]", "")
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select(
        key.alias("date_id"), F.concat(F.lit("D:"), stamp, zone).alias("raw")
    )
    cases = spark.createDataFrame(
        [(-i, raw) for i, raw in enumerate(DATE_CASES, start=1)], "date_id long, raw string"
    )
    return orders.unionByName(cases)


def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each web page is a file named by its id."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ordinal"),
        F.col("url").alias("file_path"),
        F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.octet_length("html").cast("long").alias("file_size_bytes"),
        F.timestamp_seconds(F.lit(FIRST_MODIFIED) + F.col("page_id") * 60).alias("file_modified_at"),
        F.encode("html", "UTF-8").alias("content"),
    )


def query_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, query): each whole benchmark passage."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
