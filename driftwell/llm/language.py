"""Language ID with spans: script ranges, word scores from letter trigrams, Viterbi with a switching penalty.

Training counts, per language, the letter trigrams of all words (hashed to a fixed number of cells) and
the scripts its words are written in; the counts are sums over all labelled rows, and the model's size
depends on the cells and languages alone. Prediction cuts a text into words (runs of letters), lets the
script of a word's first letter narrow the candidate languages, scores the word for each of them, and
finds the best labelling of the word sequence when every change of language costs ``penalty``. A text's
language is the one with most letters, its score their share of all letters.

Null, empty and letterless texts get ``und``, score 0 and no spans; so does every text if nothing was
learned. Equal totals go to the language that sorts first. Rows with a null language or null text are not
learned from. A word in a script no language was seen in is scored for all of them. Texts of any length,
repeated rows and other columns of any name are fine; the output column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.codes import CHARS, U64, flat_codes, letter_table, mix, runs, small_batches, spans

UNKNOWN = "und"
CELLS = 1 << 16  # hashed trigrams
SMOOTHING = 0.5
SCRIPT_SHARE = 0.001  # of a language's words, for a script to count as one of its own
PENALTY = 12.0  # nats for a change of language
OFF_SCRIPT = -1e4
BLOCK = 64

#: First and last code point of script ranges. 0 is any other script.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x531, 0x587)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)],
}
SCRIPTS = len(SCRIPT_RANGES) + 1


@cache
def script_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), start=1):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # (CELLS, languages): log probability of a trigram
    scripts: np.ndarray  # (SCRIPTS, languages): 0, or OFF_SCRIPT
    penalty: float


def words_and_cells(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Text starts, lower-case letters (0 elsewhere), word starts and ends, and each letter's trigram cell."""
    codes, starts = flat_codes(texts)
    letters = letter_table()[codes]
    first, last = spans(letters != 0)
    around = np.concatenate((np.zeros(1, np.uint32), letters, np.zeros(1, np.uint32))).astype(np.uint64)
    keys = (around[:-2] << U64(42)) | (around[1:-1] << U64(21)) | around[2:]
    cells = (mix(keys[letters != 0]) & U64(CELLS - 1)).astype(np.int64)
    return starts, codes, first, last, cells


def learned_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, cell, n) sums over all rows; cells from ``CELLS`` on count words by script."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            for run in runs(texts):
                run_langs = langs[at : at + len(run)]
                at += len(run)
                for name in set(run_langs):
                    own = [t for t, owner in zip(run, run_langs, strict=True) if owner == name]
                    _, codes, first, _, cells = words_and_cells(own)
                    counts = seen.setdefault(name, np.zeros(CELLS + SCRIPTS, np.int64))
                    counts[:CELLS] += np.bincount(cells, minlength=CELLS)
                    counts[CELLS:] += np.bincount(script_table()[codes[first]], minlength=SCRIPTS)
        for name, counts in seen.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells), pa.array(counts[cells])], names=["lang", "cell", "n"])

    rows = df.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).na.drop()
    partial = rows.mapInArrow(count, "lang string, cell long, n long")
    return partial.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text: str = "text", lang: str = "lang", penalty: float = PENALTY) -> Model:
    """The model of all labelled rows. At most languages x (cells + scripts) sums come to the driver."""
    rows = learned_counts(df, text, lang).toArrow()
    languages = tuple(sorted(set(rows.column("lang").to_pylist())))
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((CELLS + SCRIPTS, len(languages)))
    if len(languages):
        owner = np.array([place[name] for name in rows.column("lang").to_pylist()])
        counts[rows.column("cell").to_numpy(), owner] = rows.column("n").to_numpy()
    by_cell, by_script = counts[:CELLS], counts[CELLS:]
    known = max(1, int((by_cell.sum(axis=1) > 0).sum()))
    scores = np.log((by_cell + SMOOTHING) / (by_cell.sum(axis=0) + SMOOTHING * (known + 1)))
    own = by_script >= np.maximum(1, SCRIPT_SHARE * by_script.sum(axis=0))
    scripts = np.where(own | ~own.any(axis=1, keepdims=True), 0.0, OFF_SCRIPT)
    return Model(languages, scores.astype(np.float32), scripts.astype(np.float32), penalty)


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word. ``starts``: first word of each text (one more at the end).

    Exact. Texts are cut into blocks of 64 words; for all blocks at once the best path from each label
    before the block to each label at its end is found, then the blocks of a text are chained.
    """
    n_labels = scores.shape[1]
    per_text = np.diff(starts)
    blocks = -(-per_text // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    text_of = np.repeat(np.arange(len(per_text)), blocks)
    ordinal = np.arange(total) - first_block[text_of]
    begin = starts[:-1][text_of] + ordinal * BLOCK
    length = np.minimum(BLOCK, starts[1:][text_of] - begin)
    every = np.arange(n_labels)
    step = np.minimum(begin, len(scores) - 1)
    paths = np.broadcast_to(scores[step][:, None, :], (total, n_labels, n_labels)) - np.where(ordinal[:, None, None] == 0, 0, penalty * (every[:, None] != every[None, :])).astype(np.float32)
    back = np.empty((BLOCK, total, n_labels, n_labels), dtype=np.int16)
    longest = int(length.max(initial=0))
    for t in range(1, longest):
        goes = (t < length)[:, None, None]
        arg = paths.argmax(axis=2)
        jump = np.take_along_axis(paths, arg[:, :, None], 2) - np.float32(penalty)
        change = goes & (jump > paths)
        back[t] = np.where(change, arg[:, :, None], every)
        here = scores[np.minimum(begin + t, len(scores) - 1)][:, None, :]
        paths = np.where(goes, np.where(change, jump, paths) + here, paths)
    # Chain the blocks of each text; texts with most blocks first, so that the open ones are a prefix.
    order = np.argsort(-blocks, kind="stable")
    order = order[blocks[order] > 0]
    counts, firsts = blocks[order], first_block[order]
    reached = paths[firsts, 0, :].astype(np.float64)
    came = np.zeros((total, n_labels), dtype=np.int16)
    rounds = int(counts.max(initial=0))
    open_at = [int(np.searchsorted(-counts, -k, side="left")) for k in range(rounds)]
    for k in range(1, rounds):
        n = open_at[k]
        at = firsts[:n] + k
        sums = reached[:n, :, None] + paths[at]
        came[at] = sums.argmax(axis=1)
        reached[:n] = sums.max(axis=1)
    end, entry = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    label = reached.argmax(axis=1)
    for k in range(rounds - 1, -1, -1):
        n = open_at[k]
        at = firsts[:n] + k
        end[at] = label[:n]
        if k:
            entry[at] = came[at, label[:n]]
            label[:n] = entry[at]
    labels = np.empty((total, BLOCK), dtype=np.int16)
    current, rows = end, np.arange(total)
    for t in range(longest - 1, -1, -1):
        labels[:, t] = current
        if t:
            current = back[t][rows, entry, current].astype(np.int64)
    return labels[np.arange(BLOCK)[None, :] < length[:, None]]


def label_texts(model: Model, texts: list[str]) -> tuple[list, list, list]:
    """Per text: language, score, spans (start, end, language) in code points."""
    starts, codes, first, last, cells = words_and_cells(texts)
    words_at = np.searchsorted(first, starts)
    if not len(first) or not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    letters = last - first
    scores = np.add.reduceat(model.scores[cells], np.cumsum(letters) - letters, axis=0)
    scores += model.scripts[script_table()[codes[first]]]
    labels = viterbi(scores, words_at, model.penalty)
    text_of = np.repeat(np.arange(len(texts)), np.diff(words_at))
    n = len(model.languages)
    share = np.bincount(text_of * n + labels, weights=letters, minlength=len(texts) * n).reshape(len(texts), n)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    langs = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)]
    score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0)
    fresh = np.flatnonzero(np.concatenate(([True], (np.diff(text_of) != 0) | (np.diff(labels) != 0))))
    until = np.concatenate((fresh[1:], [len(first)])) - 1
    found: list[list] = [[] for _ in texts]
    for a, b in zip(fresh, until, strict=True):
        d = text_of[a]
        found[d].append({"start": int(first[a] - starts[d]), "end": int(last[b] - starts[d]), "lang": model.languages[labels[a]]})
    return langs, score.tolist(), found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def identify(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Adds the column ``out``: struct of lang, score, and spans with start, end (code points) and lang."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    chars = max(1 << 14, CHARS * 16 // max(16, len(model.languages) ** 2))  # path memory grows with the square

    @F.arrow_udf("struct<lang:string,score:double,spans:array<struct<start:long,end:long,lang:string>>>")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores, found = [], [], []
            for texts in runs(batch.to_pylist(), chars):
                a, b, c = label_texts(shared.value, texts)
                langs += a
                scores += b
                found += c
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(found, SPANS)], names=["lang", "score", "spans"])

    return df.withColumn(out, identified(F.col(f"`{text}`")))
