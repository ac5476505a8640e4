"""Cleans ``documents`` for training: each stage works on all that the one before it kept.

Every stage but the last returns rows with the columns of its input; the last one returns the
token ids. ``run`` writes each stage as Parquet to the shared folder and reads it again.

What holds for every stage: a table may be empty, and then so is the result. A null text counts as an
empty one; it is kept as null. Rows with a null id are rows like others. Columns besides ``doc_id``
and ``text`` pass through whatever their names are. Decisions are made for pairs of id and text, so
repeated rows share theirs. Texts are taken whole, however long they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, neardup, quality, secrets
from quire.llm.common import written
from quire.session import ship_package

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


#: Similarity of near copies in hundredths.
NEAR_PERCENT = 80
#: Keys of dropped documents that are broadcast (some 50 bytes each); with more of them texts are shuffled.
BROADCAST_ROWS = 500_000


def _rows(docs: DataFrame) -> DataFrame:
    """(row, text_key): whole rows in one column, so that no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("text_key"))


def _picked(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return rows.join(keys, rows["row.doc_id"].eqNullSafe(keys["id"]) & (rows["text_key"] == keys["key"]), how)


def _kept(docs: DataFrame, decided: DataFrame, condition: str) -> DataFrame:
    """Rows of ``docs`` but those whose (doc_id, text) fails the condition in ``decided``, which has every row."""
    decided = written(decided.select("doc_id", "text_key", F.expr(condition).alias("stays")), "pipeline-decisions")
    return _picked(_rows(docs), decided.where("NOT stays"), "left_anti").select("row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier does not sample.

    A null or empty text, or one shorter than an n-gram, weighs 0, and is dropped or kept by that. Texts
    that tie with the last one sampled stay. Without labelled good texts everything stays.
    """
    model = quality.fit(docs, quality.good(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return _kept(docs, quality.classify(docs, model), "accepted")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id, once if its row is repeated.

    Texts without words, null ones among them, are near nothing. Rows without an id are near nothing; a
    repeated one stays once like any other row. Of several texts with one id one is compared, and all share its fate.
    """
    found = written(neardup.near_duplicates(docs, percent=NEAR_PERCENT), "pipeline-near-duplicates")
    kept = _kept(docs, found, "kept")
    repeated = found.where("kept").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    once = _picked(_rows(kept), repeated, "left_anti").select("row.*")
    return once.unionByName(_picked(_rows(kept), repeated, "left_semi").select("row.*").dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item; a text without words holds none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, decontaminate.decontaminate(docs, items), "n_hit = 0")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mask; ``n_chars`` follows where the table has it. No row goes; null texts stay null."""
    ratios = secrets.train(secrets.labelled_tokens(spark, docs))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("given"))
    found = secrets.with_masked(secrets.scan(rows, ratios, "given"), "given", "secrets", "masked")
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("secrets") > 0, F.length("masked")).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens, ids_sha256, decoded_sha256): packed ids and digests of ids and their decoding.

    One row per row, repeated ones included; a null or empty text has no tokens.
    """
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "token_ids", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: MinHash, the Markov models and the merges of the tokenizer are not SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
