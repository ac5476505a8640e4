"""Relational steps of a load: what is new, what wins, roll-ups and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.identity import document_id, page_id

# At most this many ordinals of eight bytes are broadcast; with more, Spark joins by a shuffle.
BROADCAST_ORDINALS = 5_000_000
# Parts that the rows of one key are dealt over where a key may be hot.
SALTS = 16


def already_loaded(files: DataFrame, documents: DataFrame) -> DataFrame:
    """Files whose bytes are stored already, with the stored id."""
    stored = documents.select("sha256_hex", F.col("document_id").alias("stored_document_id"))
    return join_unique(files, stored, "sha256_hex", how="inner")


def choose_winners(files: DataFrame, replace: bool = False) -> DataFrame:
    """One file row per distinct content: the first, or with ``replace`` the last, in load order.

    An aggregate with partial results, not a window: if a third of all files are copies of
    one, each task keeps one row of them.
    """
    others = [c for c in files.columns if c not in ("ordinal", "sha256_hex")]
    row = F.struct("ordinal", *others)
    pick = F.max_by if replace else F.min_by
    return (
        files.groupBy("sha256_hex").agg(pick(row, F.col("ordinal")).alias("_row"))
        .select("_row.ordinal", "sha256_hex", *[f"_row.{c}" for c in others])
    )


def files_to_load(files: DataFrame, documents: DataFrame, replace: bool = False) -> DataFrame:
    """The winners that have to be loaded, with ``replaces`` set where stored rows give way.

    Both join sides are unique by document id, so no group is larger than one row.
    """
    winners = choose_winners(files, replace)
    stored = documents.select("document_id", F.lit(True).alias("_stored"))
    if not replace:
        new = winners.join(stored, "document_id", "left_anti")
        return new.withColumn("replaces", F.lit(False))
    return winners.join(stored, "document_id", "left").withColumn(
        "replaces", F.coalesce("_stored", F.lit(False))
    ).drop("_stored")


def chosen_content(files: DataFrame, described: DataFrame, chosen: DataFrame) -> DataFrame:
    """(document_id, content) of the chosen files, where the bytes are in a table.

    Bytes are not shuffled for it: the shorter list, chosen or skipped ordinals, is broadcast
    (eight bytes each, up to a counted limit) and the ids are worked out from the bytes again.
    """
    n_chosen = chosen.count()
    n_skipped = described.count() - n_chosen
    content = files.select("ordinal", "content")
    if n_skipped > n_chosen:
        kept = content.join(_listed(chosen.select("ordinal"), n_chosen), "ordinal", "left_semi")
    elif n_skipped:
        skipped = described.select("ordinal").join(chosen.select("ordinal"), "ordinal", "left_anti")
        kept = content.join(_listed(skipped, n_skipped), "ordinal", "left_anti")
    else:
        kept = content
    return kept.select(document_id(F.sha2("content", 256)).alias("document_id"), "content")


def _listed(ordinals: DataFrame, n: int) -> DataFrame:
    return F.broadcast(ordinals) if n <= BROADCAST_ORDINALS else ordinals


def join_unique(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Equi-join to a side with unique keys, where a few keys may hold most of ``rows``.

    The rows of each key are dealt over ``SALTS`` parts by a hash of themselves, and each lookup
    row is copied to every part, so no key is one task's work, however many hot keys there are.
    """
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", salt)
    return salted.join(lookup.withColumn("_salt", every), [key, "_salt"], how).drop("_salt")


def page_totals(pages: DataFrame) -> DataFrame:
    """Text statistics per document. Sums over all pages, blank ones included.

    A page has text exactly if its extraction method is not ``none``, so ``page_text`` is not read.
    """
    is_unread = (F.col("extraction_method") == "none") & (F.col("image_count") > 0)
    return pages.groupBy("document_id").agg(
        F.count("*").cast("int").alias("pages_extracted"),
        F.count_if(F.col("extraction_method") != "none").cast("int").alias("pages_with_text"),
        F.count_if(F.col("extraction_method") == "ocr").cast("int").alias("pages_ocr"),
        F.sum(F.col("char_count").cast("long")).alias("total_text_chars"),
        F.count_if(is_unread).cast("int").alias("pages_needing_ocr"),
    )


def chunk_totals(chunks: DataFrame) -> DataFrame:
    """Chunk counts as stored, read without the bytes."""
    return chunks.groupBy("document_id").agg(F.count("*").cast("int").alias("chunk_count"))


def roll_up(files: DataFrame, pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """File rows (unique by document) with their page and chunk statistics; 0 where there are none."""
    joined = files.join(page_totals(pages), "document_id", "left").join(
        chunk_totals(chunks), "document_id", "left"
    )
    zero = {"pages_extracted": "int", "pages_with_text": "int", "pages_ocr": "int",
            "total_text_chars": "long", "pages_needing_ocr": "int", "chunk_count": "int"}
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast(kind)) for c, kind in zero.items()})


def load_report(
    files: DataFrame, loaded: DataFrame, replace: bool = False, failed: DataFrame | None = None
) -> DataFrame:
    """One row per input file. ``pages_needing_ocr`` are blank pages with images, left as they are
    for want of an OCR engine or because it found nothing.

    ``loaded`` holds the rolled-up winners. Without ``replace`` a file is ``loaded`` exactly if
    it is its content's winner, a join on the unique ordinal. With ``replace`` every file
    reports ``loaded`` with its content's numbers. ``failed`` are files that have an ``error``
    of their own, or share their content with a (document_id, error) of ``failed``. ``extract_seconds`` is
    what a plug-in took for the file, at the file that was extracted; copies have none.
    """
    counts = ["chunk_count", "pages_extracted", "pages_with_text", "pages_ocr", "pages_needing_ocr",
              "total_text_chars", "hidden_layers_revealed"]
    if failed is not None:
        files = join_unique(files, failed.withColumnRenamed("error", "_error"), "document_id")
        files = files.withColumn("error", F.coalesce("error", "_error")).drop("_error")
    if replace:
        took = loaded.select("document_id", *counts, F.col("ordinal").alias("_winner"), F.col("extract_seconds").alias("_seconds"))
        joined = join_unique(files, took, "document_id").withColumn(
            "extract_seconds", F.when(F.col("ordinal") == F.col("_winner"), F.col("_seconds"))
        )
    else:
        joined = files.join(loaded.select("ordinal", *counts, "extract_seconds"), "ordinal", "left")
    is_loaded = F.col("pages_extracted").isNotNull()
    status = F.when(F.col("error").isNotNull(), "failed").when(is_loaded, "loaded").otherwise("skipped")
    return joined.select(
        "ordinal", "file_name", "document_id", status.alias("status"), "file_size_bytes",
        F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"),
        F.coalesce("pages_extracted", "page_count", F.lit(0)).alias("page_count"),
        F.coalesce("pages_with_text", F.lit(0)).alias("pages_with_text"),
        F.coalesce("pages_ocr", F.lit(0)).alias("pages_ocr"),
        F.coalesce("pages_needing_ocr", F.lit(0)).alias("pages_needing_ocr"),
        F.coalesce("total_text_chars", F.lit(0).cast("long")).alias("total_text_chars"),
        F.coalesce("hidden_layers_revealed", F.lit(False)).alias("hidden_layers_revealed"),
        "error", "extract_seconds",
    )


def dry_run(
    files: DataFrame, pages: DataFrame, failed: DataFrame | None = None, reveal_hidden_layers: bool = False
) -> DataFrame:
    """What a load would find, per input file. ``pages`` and ``failed`` carry the ordinal as their document id."""
    by_ordinal = lambda rows: rows.withColumn("ordinal", F.col("document_id").cast("long")).drop("document_id")
    joined = files.join(by_ordinal(page_totals(pages)), "ordinal", "left")
    if failed is not None:
        joined = joined.join(by_ordinal(failed).withColumnRenamed("error", "_error"), "ordinal", "left")
        joined = joined.withColumn("error", F.coalesce("error", "_error"))
    nothing = F.array().cast("array<string>")
    return joined.select(
        "ordinal", "file_name", "file_size_bytes", "page_count",
        F.coalesce("pages_with_text", F.lit(0)).alias("pages_with_text"),
        F.coalesce("pages_ocr", F.lit(0)).alias("pages_ocr"),
        F.coalesce("total_text_chars", F.lit(0).cast("long")).alias("total_text_chars"),
        "hidden_layer_names",
        F.when(F.lit(reveal_hidden_layers), F.col("hidden_layer_names")).otherwise(nothing).alias("revealed_layer_names"),
        "error",
    )


def migrate_page_id(pages: DataFrame) -> DataFrame:
    """Add and fill ``page_id`` on page rows that were stored without it."""
    if "page_id" in pages.columns:
        return pages
    return pages.withColumn("page_id", page_id(F.col("document_id"), F.col("page_number")))
