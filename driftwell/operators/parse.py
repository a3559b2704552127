"""Message bytes to JSON values, with a quarantine route for what is not JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.config import PARSE_STAGE
from driftwell.functions.text import utf8_text, with_strict_json

PARSE_ERROR = "message is not a single valid JSON value"


def parse_messages(messages: DataFrame) -> DataFrame:
    """Adds ``message`` (text), ``record`` (VARIANT) and ``route`` (valid/invalid)."""
    others = [c for c in messages.columns if c != "value"]
    texts = messages.selectExpr(*others, f"{utf8_text('value')} AS message")
    parsed = with_strict_json(texts, "message", "record")
    return parsed.withColumn("route", F.when(F.col("record").isNull(), "invalid").otherwise("valid"))


def parser_dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("route") == "invalid").select(
        F.col("message").alias("raw_message"),
        F.lit(PARSE_STAGE).alias("error_stage"),
        F.lit(PARSE_ERROR).alias("error_message"),
    )
