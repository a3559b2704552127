"""Licence scan: Dice coefficient of word bigrams against licence templates, in SQL expressions only.

A text's units are its lines, its blocks between blank lines, and the whole text. A unit is put in lower case,
anything but letters and digits becomes one space, and its distinct word bigrams are compared with those of
each template whose number of bigrams allows the coefficient to reach ``min_dice``: for a template of b bigrams
and a unit of a, 2 min(a, b) / (a + b) bounds it. Other templates are never compared.

A licence that no unit matches is looked for within the text, across lines, blocks and sentences: windows of words
are compared, from every bigram of the template on and of the lengths in ``WINDOWS`` times its own, and the best
one counts as one match. Only templates of which the whole text holds as many bigrams as ``min_dice`` takes at least
are looked for in this way. Repeats of a licence that a unit matches are counted by units alone.

The templates listed are MIT, ISC, the headers of Apache-2.0 and GPL-3.0, and notices of these and of CC BY, BY-SA and
BY-NC 4.0. Not listed, so not found: BSD, MPL, LGPL, AGPL, GPL-2.0, Unlicense, CC0, BSL, and the full texts of Apache,
GPL and CC.

The templates are a list given by the caller, part of the plan; one pass over the texts, no shuffle. Null and
empty texts and units of fewer than two words match nothing. Of equal coefficients the licence that sorts
first is the best. Texts of any length, repeated rows and other columns of any name are fine; the output
column replaces one of the same name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.expressions import bind
from driftwell.llm.license_texts import TEMPLATES

MIN_DICE = 0.8
WINDOWS = (0.67, 0.8, 1.0, 1.25, 1.5)  # at 0.8, bigrams beyond 1.5 or below 0.67 of a template's cannot reach it


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _literal(templates: dict[str, str]) -> Column:
    rows = [
        F.struct(F.lit(name).alias("license"), F.array(*[F.lit(b) for b in template_bigrams(text)]).alias("bigrams"))
        for name, text in sorted(templates.items())
    ]
    return F.array(*rows)


def positional_bigrams(unit: Column) -> Column:
    """Bigrams of a unit that is already normalised, in order."""

    def of(words: Column) -> Column:
        ends = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        return F.zip_with(F.slice(words, 1, F.size(ends)), ends, lambda a, b: F.concat(a, F.lit(" "), b))

    return bind(F.split(F.trim(unit), " "), of)


def unit_bigrams(unit: Column) -> Column:
    """Distinct bigrams of a unit that is already normalised."""
    return F.array_distinct(positional_bigrams(unit))


def matches(text: Column, templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE) -> Column:
    """Array of struct(license, dice): every unit's comparison that reaches ``min_dice``."""
    listed = _literal(templates)
    cleaned = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")

    def units(value: Column) -> Column:
        lines = F.split(value, r"\n", -1)
        blocks = F.transform(F.split(value, r"\n *\n[ \n]*", -1), lambda b: F.regexp_replace(b, r"[ \n]+", " "))
        whole = F.regexp_replace(value, r"[ \n]+", " ")
        return F.array_distinct(F.transform(F.concat(lines, blocks, F.array(whole)), lambda u: F.trim(u)))

    def compared(bigrams: Column) -> Column:
        a = F.size(bigrams)

        def bound(t: Column) -> Column:
            return 2.0 * F.least(a, F.size(t["bigrams"])) / (a + F.size(t["bigrams"]))

        near = F.filter(listed, lambda t: (a > 0) & (bound(t) >= min_dice))
        scored = F.transform(
            near,
            lambda t: F.struct(t["license"].alias("license"), (2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (a + F.size(t["bigrams"]))).alias("dice")),
        )
        return F.filter(scored, lambda s: s["dice"] >= min_dice)

    every = F.array(*[F.lit(b) for b in sorted({b for t in templates.values() for b in template_bigrams(t)})])

    def best_window(grams: Column, t: Column) -> Column:
        """The greatest coefficient of a window, or null."""
        own = F.size(t["bigrams"])
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(grams), F.lit(1))), lambda i: F.array_contains(t["bigrams"], F.get(grams, i - 1)))

        def dice(i: Column, share: float) -> Column:
            window = F.array_distinct(F.slice(grams, i, F.greatest(F.ceil(own * share).cast("int"), F.lit(1))))
            return bind(window, lambda w: 2.0 * F.size(F.array_intersect(w, t["bigrams"])) / (F.size(w) + own))

        return F.array_max(F.transform(starts, lambda i: F.greatest(*[dice(i, share) for share in WINDOWS])))

    def passages(value: Column, known: Column) -> Column:
        """Matches within the text of licences that are not ``known``."""

        def of(grams: Column) -> Column:
            def listed_in(held: Column) -> Column:
                least = min_dice / (2.0 - min_dice)
                likely = F.filter(
                    listed, lambda t: ~F.exists(known, lambda m: m["license"] == t["license"]) & (F.size(F.array_intersect(held, t["bigrams"])) >= least * F.size(t["bigrams"]) - 1e-9)
                )
                return F.transform(likely, lambda t: F.struct(t["license"].alias("license"), best_window(grams, t).alias("dice")))

            return F.filter(bind(F.array_intersect(grams, every), listed_in), lambda s: s["dice"] >= min_dice)

        return bind(positional_bigrams(F.regexp_replace(value, r"[ \n]+", " ")), of)

    in_units = bind(cleaned, lambda value: F.struct(value.alias("value"), F.flatten(F.transform(units(value), lambda u: bind(unit_bigrams(u), compared))).alias("known")))
    found = bind(in_units, lambda s: F.concat(s["known"], passages(s["value"], s["known"])))
    return F.coalesce(found, F.array().cast("array<struct<license:string,dice:double>>"))


def scan(df: DataFrame, text: str = "text", out: str = "license_scan", templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """Adds ``out``: struct(matches, licenses (distinct, sorted), best, best_dice)."""
    best = F.array_sort(
        F.col("__license_matches"),
        lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0),
    )
    one = df.withColumn("__license_matches", F.explode(F.array(matches(F.col(f"`{text}`"), templates, min_dice))))
    result = F.struct(
        F.col("__license_matches").alias("matches"),
        F.array_sort(F.array_distinct("__license_matches.license")).alias("licenses"),
        F.get(best, F.lit(0))["license"].alias("best"),
        F.get(best, F.lit(0))["dice"].alias("best_dice"),
    )
    return one.withColumn(out, result).drop("__license_matches")
