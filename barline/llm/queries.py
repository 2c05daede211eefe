"""The query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import alignment, audit, bpe, chat, jaccard, language, lm, mixing, quality, sharding, topk, toxicity, urls
from barline.llm.common import fold, store, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.formatted(rows.unionByName(extra)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 10) == 0
    return lm.learn_and_score(docs, ~held_out).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = store(quality.measure(docs).drop("text"), "measured")
    return quality.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = language.learned(docs, ~held_out, docs.select("doc_id", "text"))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels")
    good, toxic = labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id")
    return audit.audit(*audit.relations(docs, F.coalesce("lang", F.lit("")), good, toxic))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def queries() -> dict:
    """The query of each operator by its name."""
    return {f.__name__: f for f in (
        op1_exact_topk, op2_url_filters, op3_ngram_jaccard_join, op4_chat_formatting,
        op5_toxicity, op6_lm_scoring, op7_quality_rules, op8_language_id, op9_byte_bpe, op10_mixing, op11_token_alignment, op12_filter_audit, op13_sharding)}
