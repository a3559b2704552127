"""Number expressions, as SQL."""

from __future__ import annotations

from driftwell.functions.text import strip

_DECIMAL_TEXT = r"(?U)^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def json_double(text: str, kind: str) -> str:
    """A JSON number, boolean or numeric string as DOUBLE; NULL for anything else.

    ``kind`` is the member's JSON type. The pattern keeps out of strings what the cast would also
    take: ``1d``, ``NaN``, ``Infinity``.
    """
    return (
        f"CASE WHEN {kind} = 'STRING' THEN CASE WHEN {text} rlike r'{_DECIMAL_TEXT}' "
        f"THEN try_cast({strip(text)} as double) END "
        f"WHEN {kind} = 'BOOLEAN' THEN if({text} = 'true', 1D, 0D) "
        f"ELSE try_cast({text} as double) END"
    )


def repr_text(number: str) -> str:
    """Shortest decimal text: plain from 1e-4 up to 1e16, else in the style of ``1e-05`` and ``1e+16``."""
    text = f"cast({number} as string)"
    digits = f"regexp_replace(regexp_extract({text}, r'([\\d.]+)E', 1), r'\\.0$|\\.', '')"
    mantissa = f"regexp_replace(regexp_extract({text}, r'(-?[\\d.]+)E', 1), r'\\.0$', '')"
    exponent = f"regexp_extract({text}, r'E-?(\\d+)', 1)"
    scientific = f"concat({mantissa}, if(abs({number}) < 1, 'e-', 'e+'), lpad({exponent}, greatest(length({exponent}), 2), '0'))"
    plain = f"regexp_replace(cast(cast({text} as decimal(28, 11)) as string), r'(\\.\\d+?)0+$', '$1')"
    return (
        f"CASE WHEN {number} = 0 OR abs({number}) >= 1e-3 AND abs({number}) < 1e7 THEN {text} "
        f"WHEN abs({number}) >= 1e-4 AND abs({number}) < 1 THEN concat(if({number} < 0, '-', ''), '0.000', {digits}) "
        f"WHEN abs({number}) >= 1e7 AND abs({number}) < 1e16 THEN {plain} ELSE {scientific} END"
    )
