"""Canonical payload fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame

from driftwell.config import REQUIRED_FIELDS, SENSORS
from driftwell.functions.numbers import repr_text
from driftwell.functions.text import json_string, strip
from driftwell.functions.times import iso_text


def canonical_payload() -> str:
    """Compact JSON of the seven fields in name order: ids stripped, numbers as doubles, UTC time."""

    def value(field):
        if field in SENSORS:
            return repr_text(field)
        if field == "event_timestamp":
            return f"concat('\"', {iso_text(field)}, '\"')"
        return json_string(strip(field))

    parts = [f"concat('\"{field}\":', coalesce({value(field)}, 'null'))" for field in sorted(REQUIRED_FIELDS)]
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def fingerprint(records: DataFrame) -> DataFrame:
    return records.selectExpr("*", f"sha2({canonical_payload()}, 256) AS payload_hash")
