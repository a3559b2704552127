"""From raw documents to token ids: five stages, each an operator of ``driftwell.llm`` over all rows of the one before.

Every stage but the last returns the columns of its input. Null texts leave in the first stage (no language);
null sources, languages and ids are fine throughout; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm import language, mixing, near_duplicates, personal_data
from driftwell.llm.queries import encoded, held_out
from driftwell.session import materialize

LEAST_SHARE = 0.3  # of a text's letters in its main language


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a main language and labels them with it."""
    model = language.train(docs.filter(~held_out(F.col("doc_id"))))
    found = language.identify(docs, model, out="__language")
    kept = found.filter((F.col("__language.lang") != language.UNKNOWN) & (F.col("__language.score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.col("__language.lang")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return near_duplicates.drop_near_duplicates(docs).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    redacted = personal_data.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.apply_mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return encoded(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: Signatures, trees and merges are not SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
