"""Quarantine messages: both invalid streams as JSON text in one bag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.config import PARSE_STAGE, VALIDATION_STAGE
from driftwell.operators.parse import PARSE_ERROR


def _parser_text() -> Column:
    return F.to_json(F.struct("raw_message", "error_stage", "error_message"))


def _validator_text() -> Column:
    """The original record goes in verbatim: it is known to be one JSON value.

    Line breaks in JSON can only stand between tokens, so one-line text is safe.
    """
    return F.concat(
        F.lit('{"record":'),
        F.translate("record", "\r\n\t", "   "),
        F.lit(',"error_stage":"'),
        F.col("error_stage"),
        F.lit('","errors":'),
        F.to_json("errors"),
        F.lit("}"),
    )


def dead_letters(parser_letters: DataFrame, validator_letters: DataFrame) -> DataFrame:
    """Both kinds of letters as one bag of texts."""
    return parser_letters.select(_parser_text().alias("value")).unionByName(
        validator_letters.select(_validator_text().alias("value"))
    )


def letters_by_stage(checked: DataFrame) -> DataFrame:
    """``error_stage, value`` of every rejected message, in one pass over the routed messages."""
    rejected = checked.filter(F.col("route") != "valid").select(
        F.col("message").alias("raw_message"),
        F.col("message").alias("record"),
        F.when(F.col("route") == "unparsed", PARSE_STAGE).otherwise(VALIDATION_STAGE).alias("error_stage"),
        F.lit(PARSE_ERROR).alias("error_message"),
        "errors",
    )
    text = F.when(F.col("error_stage") == PARSE_STAGE, _parser_text()).otherwise(_validator_text())
    return rejected.select("error_stage", text.alias("value"))
