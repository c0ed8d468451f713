"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Toxic documents go; one document of each near-duplicate group stays; documents with
benchmark windows go; personal data is masked; what is left is encoded by SentencePiece.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import decontaminate, jaccard, personal, sentencepiece_fst, toxicity
from shelfline.llm.common import saved, table
from shelfline.llm.queries import PIECE_MODEL

#: Most rows of an Arrow batch.
BATCH = 1_000
#: Fragments and words a worker remembers: it follows four stages whose memory the JVM keeps.
REMEMBERED = 100_000


def _short_batches(spark: SparkSession) -> None:
    """Texts can be long: fewer rows in a batch that travels to a Python worker and back.

    Only memory follows from it; a session that asks for less keeps its own setting.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, str(BATCH))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return jaccard.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = personal.masked(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, with ``pieces`` and their number."""
    _short_batches(spark)
    found = sentencepiece_fst.encode(docs, public_tokenizers.path(PIECE_MODEL), cache=REMEMBERED)
    return found.withColumn("n_pieces", F.size("pieces").cast("long")).drop("text")


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("sentencepiece", encoded),
]

#: Votes, components and token ids are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    name, stage = STAGES[-1]
    return saved(stage(spark, docs, sf_dir), name)
