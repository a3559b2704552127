"""String expressions, as SQL: stripping, strict JSON, JSON string escaping."""

from __future__ import annotations

from pyspark.sql import DataFrame

from driftwell.functions.once import compute_once

# Unicode white space plus the four ASCII separators 1C-1F.
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: str) -> str:
    # Only a text with a blank at an edge pays for the replacement.
    return (
        f"if({text} rlike r'(?U)^{_BLANK}|{_BLANK}$', "
        f"regexp_replace({text}, r'(?U)^{_BLANK}+|{_BLANK}+$', ''), {text})"
    )


def utf8_text(value: str) -> str:
    """Bytes as text; broken sequences become U+FFFD instead of failing the query."""
    return f"make_valid_utf8(cast({value} as string))"


def with_strict_json(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the text column as VARIANT, NULL unless the whole text is exactly one JSON value.

    The built-in parser stops after the first value. Parsing ``[text, digest]`` and asking for the
    digest at position 1 makes anything after (or short of) one value visible.
    """
    digested = df.selectExpr("*", f"md5({text}) AS _digest")
    pairs = compute_once(digested, _pair=f"try_parse_json(concat('[', {text}, ',\"', _digest, '\"]'))")
    complete = "try_variant_get(_pair, '$[1]', 'string') = _digest"
    value = f"CASE WHEN {complete} THEN try_variant_get(_pair, '$[0]', 'variant') END"
    return compute_once(pairs, **{name: value}).drop("_digest", "_pair")


def json_string(text: str) -> str:
    """``text`` as an ASCII-only JSON string literal, quotes included."""
    units = f"hex(encode({text}, 'UTF-16BE'))"
    escaped = f"array_join(transform(sequence(1, length({units}) - 3, 4), i -> {_escape(f'substr({units}, i, 4)')}), '')"
    return f"""concat('"', if({text} rlike r'[^ -~]|["\\\\]', {escaped}, {text}), '"')"""


def _escape(unit: str) -> str:
    code = f"cast(conv({unit}, 16, 10) as int)"
    # JSON short escapes by code unit.
    short = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r", 34: '"', 92: "\\\\"}
    cases = " ".join(f"WHEN {value} THEN concat(chr(92), '{letter}')" for value, letter in short.items())
    plain = f"if({code} between 32 and 126, chr({code}), concat(chr(92), 'u', lower({unit})))"
    return f"CASE {code} {cases} ELSE {plain} END"
