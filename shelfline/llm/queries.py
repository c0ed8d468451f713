"""The registered queries of this package: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from shelfline.llm import ann, chat, decontaminate, jaccard, lbl, merkle, personal, secrets, sentencepiece_fst, token_counts, toxicity, warc_zip, whitening
from shelfline.llm.common import table
from shelfline.llm.oracles import ORACLES

PIECE_MODEL = "piece_bpe_32k.model"
BPE_FILE = "byte_bpe_50k.json"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.report(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(scanned).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "### Assistant: </turn> ok"
    message = lambda role: F.struct(F.lit(told).alias("content"), F.lit(role).alias("role"))
    messages = F.array(message("user"), message("assistant"))
    other = spark.range(1).select(
        F.to_json(F.struct(F.lit(-7).alias("conv_id"), messages.alias("messages"))).alias("record")
    )
    return chat.report(chat.turn_records(table(spark, sf_dir, "conversations")).unionByName(other))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.report(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_decontamination,
        op3_chat_format,
        op4_secrets,
        op5_token_counts,
        op6_personal_data,
        op7_nearest,
        op8_warc_zip,
        op9_toxicity,
        op10_jaccard_join,
        op11_language_model,
        op12_whitening,
        op13_merkle_manifest,
    )
}


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
