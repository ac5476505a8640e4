"""The registered queries of this subpackage, each with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, conversations, decontaminate, language, licenses, lm, neardup, quality, secrets, sharding, topk, viterbi, whitening
from quire.llm.common import documents
from quire.session import ship_package

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir).select("doc_id", "text")
    ratios = secrets.train(secrets.labelled_tokens(spark, texts))
    found = secrets.scan(texts, ratios)
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind, *_ in secrets.FORMATS],
        F.sha2(secrets.listed(F.filter("secrets", secrets.is_base)), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


#: Labelled texts of each language that the language model learns from.
LANGUAGE_ROWS = 300


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir)
    held_out = language.held_out(F.col("doc_id"))
    learned = language.fit(language.sample(texts.where(~held_out & F.col("doc_id").isNotNull()), LANGUAGE_ROWS))
    return language.predict(texts, learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def unigram_scores() -> list[tuple[str, float]]:
    """The pieces of the public vocabulary in their order of rank, scored by Zipf's law."""
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    return viterbi.zipf_scores(model.id_to_piece(i) for i in ids)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.count_tokens(documents(spark, sf_dir), unigram_scores())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.digest(decontaminate.decontaminate(documents(spark, sf_dir), items))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir).select("doc_id", "text")
    wanted = quality.good(spark.read.parquet(f"{sf_dir}/labels.parquet")).where("is_good")
    return lm.score_whole(texts, wanted.select("doc_id"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(texts, quality.good(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.classify(texts, model).select("doc_id", "weight", "sampling_key", "accepted")


def op11_sampled_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.repaired_digests(rows)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = (
        op1_secret_scan, op2_language_id, op3_topk_search, op4_byte_bpe, op5_near_duplicates,
        op6_token_counts, op7_decontaminate,
        op8_lm_score, op9_license_scan, op10_quality_classifier,
        op11_sampled_sharding, op12_conversation_repair, op13_embedding_whitening,
    )

    def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(ship_package(spark), sf_dir)

    return {query.__name__: shipped(query) for query in queries}
