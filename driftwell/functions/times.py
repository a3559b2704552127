"""ISO-8601 timestamp expressions, as SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The common spelling, which the built-in cast reads directly.
_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"

# Extended or basic form; optional time, seconds, fraction and zone.
_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(Z|([+-])(\d{2})(?:(:?)(\d{2})(?:\13(\d{2})(?:\.\d+)?)?)?)?)?$"
)
# Group numbers of: year, month, day, hour, minute, second, fraction, zone, sign, zone h, m and s.
_GROUPS = [1, 3, 4, 5, 7, 8, 9, 10, 11, 12, 14, 15]


def iso_parts(text: str) -> str:
    """The pieces of an ISO-8601 text in an uncommon spelling; NULL for the common one."""
    pieces = "|".join(f"${g}" for g in _GROUPS)
    return (
        f"CASE WHEN NOT {text} rlike r'{_PLAIN}' AND {text} rlike r'{_ISO}' "
        f"THEN split(regexp_replace({text}, r'{_ISO}', '{pieces}'), '[|]', -1) END"
    )


def iso_timestamp(text: str, parts: str) -> str:
    """The instant ``text`` names (zone-less text read as UTC), or NULL if it is not ISO-8601."""
    plain = f"CASE WHEN {text} rlike r'{_PLAIN}' THEN try_cast({text} as timestamp) END"
    return f"if({parts} IS NULL, {plain}, {_from_parts(parts)})"


def iso_zone_missing(parts: str) -> str:
    return f"coalesce({parts}[7] = '', false)"


def _from_parts(parts: str) -> str:
    def two(i):
        return f"lpad({parts}[{i}], 2, '0')"

    local = (
        f"concat({parts}[0], '-', {parts}[1], '-', {parts}[2], 'T', {two(3)}, ':', {two(4)}, ':', {two(5)}, "
        f"rpad(concat('.', substr({parts}[6], 1, 6)), 7, '0'), 'Z')"
    )
    # The cast rejects zones beyond 18 hours, so the zone is applied as a plain difference.
    hours, minutes, seconds = (f"cast({two(i)} as int)" for i in (9, 10, 11))
    offset = (
        f"CASE WHEN {hours} < 24 AND {minutes} < 60 AND {seconds} < 60 "
        f"THEN ({hours} * 3600 + {minutes} * 60 + {seconds}) * if({parts}[8] = '-', -1000000L, 1000000L) END"
    )
    return f"timestamp_micros(unix_micros(try_cast({local} as timestamp)) - {offset})"


def iso_text(instant: str) -> str:
    """UTC ISO text; the fraction appears only when there is one, always with six digits."""
    return (
        f"concat(date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss\"), "
        f"if(unix_micros({instant}) % 1000000 = 0, '', date_format({instant}, '.SSSSSS')), '+00:00')"
    )


def plus_seconds(instant: Column, seconds: int) -> Column:
    return instant + F.expr(f"interval {seconds} seconds")
