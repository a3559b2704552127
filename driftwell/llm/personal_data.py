"""Personal data by candidate gradient boosting, in SQL expressions only.

Generators of high recall propose candidate spans of each kind, also where they overlap; format and context
features describe every candidate as a cell of small integers; boosted trees are fitted to the counts of all
cells of half of the texts, a threshold per kind is calibrated on the other half so that the labelled candidates
above it keep ``PRECISION``, and what reaches it is a span. Spans of the strict formats always stay; others must
not overlap them, nor a better or earlier one of their own.

Weak labels: a candidate in its kind's strict format is positive; one in another notation and without a cue word
before it is negative. One in another notation beside a cue has no label, and so has a number of a card's length
whose check digit fails, which says nothing about notation: these are not learned from. No feature spells out what
the strict format is made of (plus, digits, octets, check digit, the at sign, a domain), so that context decides
about unusual notation: ``phone (974) 555-3436``, ``mail joe (at) example.com``. What no notation can mend is
required of every added span (``sound``): octets up to 255, 13 to 19 digits with the check digit, 9 to 15 digits of
a phone, a domain. Candidates of equal score, start and kind are the same; else the earlier, then the first kind wins.

Everything runs as array expressions within a row, in one pass over the texts and without a shuffle of them;
what the model needs are counts of cells, bounded by the product of the features' values.

Null and empty texts have no spans; an empty table gives an empty result, and one without labelled candidates the
strict spans alone. Positions are code points, the end exclusive. Patterns are possessive,
and a match can start only where a run does, so that long texts take time in proportion to their length.
Repeated rows and other columns of any name are fine; the output column replaces one of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.boosting import Boosted, fit, threshold
from driftwell.llm.expressions import bind
from driftwell.session import materialize

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
CONTEXT = 24  # code points before a candidate that are looked at
SPAN = "struct<kind:int,start:int,end:int>"

#: The strict formats. ``\G`` lets a match start where the one before ended.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![^\s@<>()\[\]\"',;:]))[^\s@<>()\[\]\"',;:]++(?:@|\s?\(at\)\s?|\s?\[at\]\s?)[^\s@<>()\[\]\"',;:]++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\s?[.]\s?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?+[0-9]){11,}+",
    "phone": r"(?<![0-9])[+(]?+[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
}
CUE = r"(?i)(mail|tel|phone|fon|call|fax|mobile|móvil|téléphone|correo|host|addr|server|\bip\b|card|visa|iban|konto|carte|tarjeta)"
FEATURES = ("kind", "separators", "letters", "left", "right", "cue", "given")
CANDIDATE = ("start", "end", "label", "learned", "sound", *FEATURES)


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def located(text: Column, pattern: str) -> Column:
    """Array of struct(start, end, value) of all matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(between, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def add(done: Column, match: Column) -> Column:
        first = done["at"] + match["gap"]
        last = first + F.length(match["value"])
        span = F.struct(first.alias("start"), last.alias("end"), match["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    # ``zip_with`` pads the shorter list: the last gap has no match.
    matches = F.filter(sizes, lambda m: m["value"].isNotNull())
    return F.when(F.size(found) > 0, F.aggregate(matches, start, add, lambda done: done["spans"])).otherwise(start["spans"])


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    back = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(back, lambda d: d != ""), lambda d, i: (d.cast("int") * (1 + i % 2)))
    total = F.aggregate(values, F.lit(0), lambda acc, v: acc + v - F.when(v > 9, 9).otherwise(0))
    return total % 10 == 0


def small_octets(value: Column) -> Column:
    """Whether all parts between dots are numbers of at most 255."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(F.trim(p), F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.when(F.length(p) <= 3, F.concat(F.lit("0"), p)).try_cast("int"), F.lit(999)) <= 255))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    n = F.length(digits_of(value))
    if kind == "ip":
        return small_octets(value)
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), luhn(digits_of(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def strict_spans(text: Column) -> Column:
    """Array of struct(kind, start, end) by kind, then start."""

    def of(number: int, kind: str) -> Column:
        kept = F.filter(located(text, STRICT[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(kept, lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(_possible(kind, text), spans).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.concat(*[of(number, kind) for number, kind in enumerate(KINDS)])


def _possible(kind: str, text: Column) -> Column:
    """A quick test that most texts fail."""
    return text.rlike(r"@|[(\[]at[)\]]") if kind == "email" else text.rlike("[0-9]")


def _side(neighbour: Column) -> Column:
    """0: nothing or white space, 1: letter or digit, 2: else."""
    return F.when(neighbour.rlike(r"^\s?$"), 0).when(neighbour.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2)


def _bucket(value: Column, edges: list[int]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: value >= e))


def _described(kind: str, number: int, text: Column, match: Column) -> Column:
    value, start, end = match["value"], match["start"], match["end"]
    digits = digits_of(value)
    n = F.length(digits)
    before = F.substring(text, F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    left = F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise(F.lit(""))
    right = F.substring(text, end + 1, F.lit(1))
    features = {
        "kind": F.lit(number),
        "separators": _bucket(F.length(F.regexp_replace(value, "[0-9+]", "")), [1, 2, 3, 4, 5]) if kind in ("card", "phone") else F.lit(0),
        "letters": value.rlike(r"\p{L}").cast("int"),
        "left": _side(left),
        "right": _side(right),
        "cue": before.rlike(CUE).cast("int"),
        "given": before.rlike(r"=\s*\W?$").cast("int"),
    }
    strict = value.rlike(f"^(?:{STRICT[kind]})$") & _valid(kind, value)
    sound = value.rlike(r"[A-Za-z0-9-]\.[A-Za-z]{2,}$") if kind == "email" else _valid(kind, value)
    learned = strict | (features["cue"] == 0)
    if kind == "card":
        learned = learned & (sound | ~n.between(13, 19))
    told = {"start": start, "end": end, "label": strict, "learned": learned, "sound": sound, **features}
    return F.struct(*[told[name].cast("int").alias(name) for name in CANDIDATE])


def candidates(text: Column) -> Column:
    """Array of candidates of all kinds with their features, by kind and start."""
    fields = ",".join(f"{name}:int" for name in CANDIDATE)

    def of(number: int, kind: str) -> Column:
        found = F.transform(located(text, LOOSE[kind]), lambda m: _described(kind, number, text, m))
        return F.when(_possible(kind, text), found).otherwise(F.array().cast(f"array<struct<{fields}>>"))

    return F.concat(*[of(number, kind) for number, kind in enumerate(KINDS)])


def extracted(df: DataFrame, text: str, strict: str = "__pii_strict", loose: str = "__pii_loose") -> DataFrame:
    """Adds the strict spans and the candidates, each made once."""
    value = _text(F.col(f"`{text}`"))
    return df.select("*", F.inline(F.array(F.struct(strict_spans(value).alias(strict), candidates(value).alias(loose)))))


@dataclass(frozen=True)
class Model:
    trees: Boosted
    thresholds: tuple[float, ...]  # of log odds, by kind


def train(found: DataFrame, fold: str, loose: str = "__pii_loose", precision: float = PRECISION) -> Model:
    """Fits to the labelled candidates of rows with ``fold`` 0, calibrates on those with 1."""
    rows = found.select(F.col(fold).alias("fold"), F.explode(F.filter(loose, lambda c: c["learned"] == 1)).alias("c"))
    cells = rows.groupBy("fold", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(F.count(F.lit(1)).alias("rows"), F.sum("c.label").alias("positive"))
    counted = sorted(tuple(r) for r in cells.collect())  # bounded: combinations of feature values
    table = np.array(counted, dtype=np.int64).reshape(-1, len(FEATURES) + 3)
    halves = [table[table[:, 0] == f] for f in (0, 1)]
    x, n, hits = halves[0][:, 1:-2], halves[0][:, -2].astype(float), halves[0][:, -1].astype(float)
    trees = fit(x, n, hits)
    held, held_n, held_hits = halves[1][:, 1:-2], halves[1][:, -2].astype(float), halves[1][:, -1].astype(float)
    raw = np.round(trees.raw(held), 9) if len(held) else np.empty(0)
    own = [held[:, 0] == number for number in range(len(KINDS))]
    return Model(trees, tuple(threshold(raw[o], held_n[o], held_hits[o], precision) for o in own))


def selected(model: Model, strict: Column, loose: Column) -> Column:
    """Strict spans and the candidates above their threshold that overlap none, by kind and start."""

    def overlap(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def score(c: Column) -> Column:
        return _score(model.trees, {f: c[f] for f in FEATURES})

    limits = [t if math.isfinite(t) else 1e300 for t in model.thresholds]
    limit = F.array(*[F.lit(t - 1e-6) for t in limits])
    scored = F.transform(F.filter(loose, lambda c: c["sound"] == 1), lambda c: F.struct(score(c).alias("score"), c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    high = F.filter(scored, lambda c: c["score"] >= F.get(limit, c["kind"]))
    free = F.filter(high, lambda c: ~F.exists(strict, lambda s: overlap(c, s)))

    def best(found: Column) -> Column:
        def beaten(c: Column) -> Column:
            return F.exists(found, lambda o: overlap(c, o) & ((o["score"] > c["score"]) | ((o["score"] == c["score"]) & ((o["start"] < c["start"]) | ((o["start"] == c["start"]) & (o["kind"] < c["kind"]))))))

        return F.filter(found, lambda c: ~beaten(c))

    added = F.transform(bind(free, best), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return F.array_sort(F.concat(strict, added))


def _score(trees: Boosted, names: dict[str, Column]) -> Column:
    def of(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        return F.when(names[FEATURES[tree.feature]] <= tree.most, of(tree.left)).otherwise(of(tree.right))

    total = F.lit(trees.base)
    for tree in trees.trees:
        total = total + of(tree)
    return total


def find(df: DataFrame, text: str = "text", out: str = "personal_data", kept: list[str] | None = None) -> DataFrame:
    """``kept`` columns (all by default) and ``out``: struct(strict, spans), both arrays of struct(kind, start, end).

    The candidates of the kept columns' rows are written once to the shared folder; keep ids, not texts.
    """
    columns = df.columns if kept is None else kept
    fold = F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(2)).cast("int").alias("__pii_fold")
    found = extracted(df, text).select(*[F.col(f"`{c}`") for c in columns], fold, "__pii_strict", "__pii_loose")
    found = materialize(found, "candidates")
    model = train(found, "__pii_fold")
    spans = selected(model, F.col("__pii_strict"), F.col("__pii_loose"))
    result = F.struct(F.col("__pii_strict").alias("strict"), spans.alias("spans"))
    return found.withColumn("__pii_out", result).drop("__pii_strict", "__pii_loose", "__pii_fold").withColumn(out, F.col("__pii_out")).drop("__pii_out")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones together) replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        parts = F.concat(done["parts"], F.array(gap, F.get(names, span["kind"])))
        fresh = F.struct(span["end"].alias("at"), parts.alias("parts"))
        inside = F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["parts"].alias("parts"))
        return F.when(span["start"] >= done["at"], fresh).otherwise(inside)

    def finish(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(by_start, start, add, finish)).otherwise(text)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the personal data in ``text`` replaced. Null texts stay null."""
    texts = df.select(F.col(f"`{text}`").alias("text"))
    fold = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("__pii_fold")
    narrow = materialize(extracted(texts, "text").select(fold, "__pii_loose").filter(F.size("__pii_loose") > 0), "candidates")
    model = train(narrow, "__pii_fold")
    found = extracted(df, text)
    spans = F.explode(F.array(selected(model, F.col("__pii_strict"), F.col("__pii_loose")))).alias("__pii_spans")
    one = found.select("*", spans)
    return one.withColumn(text, redacted(F.col(f"`{text}`"), F.col("__pii_spans"))).drop("__pii_strict", "__pii_loose", "__pii_spans")

