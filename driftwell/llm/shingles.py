"""Word shingles of many texts as one flat array of 64-bit hashes (numpy, for Arrow UDFs).

Words are runs of anything but ASCII white space, compared in lower case. A text of fewer words than a
shingle takes has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np

from driftwell.llm.codes import U64, flat_codes, lower_table, mix, ragged, spans

WORDS = 5
BASE, STEP = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(max(n, 1), base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words start (one more at the end)."""
    codes, starts = flat_codes(texts)
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    first, last = spans(~white)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(starts), np.int64)
    low = lower_table()[codes[~white]].astype(np.uint64) + U64(1)
    lengths = last - first
    place = ragged(np.zeros(len(first), np.int64), lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(low * _powers(BASE, int(lengths.max()))[place], np.cumsum(lengths) - lengths)
        return mix(sums + BASE), np.searchsorted(first, starts)


def shingle_hashes(hashes: np.ndarray, starts: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Every shingle with the number of its text, in text order."""
    n_words = np.diff(starts)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - words + 1, 1))
    owner = np.repeat(np.arange(len(counts)), counts)
    at = ragged(starts[:-1], counts)
    until = starts[1:][owner]
    sums = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        factor = U64(1)
        for k in range(words):
            inside = at + k < until
            sums += np.where(inside, hashes[np.minimum(at + k, len(hashes) - 1)] * factor, U64(0)) if len(at) else sums
            factor *= STEP
        return mix(sums + STEP), owner


def text_keys(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's whole word sequence; all texts without words are alike."""
    n_words = np.diff(starts)
    place = ragged(np.zeros(len(n_words), np.int64), n_words).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for factor in (BASE, STEP):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes * factor + place * STEP + factor), dtype=np.uint64)))
            out.append(mix(sums[starts[1:]] - sums[starts[:-1]] + n_words.astype(np.uint64) * factor))
    return out[0], out[1]


def multisets(shingles: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, shingle, how often), sorted by owner and shingle."""
    order = np.lexsort((shingles, owner))
    o, s = owner[order], shingles[order]
    fresh = np.flatnonzero(np.concatenate(([True], (np.diff(o) != 0) | (s[1:] != s[:-1])))) if len(o) else np.empty(0, np.int64)
    return o[fresh], s[fresh], np.diff(np.concatenate((fresh, [len(o)])))


def weighted_jaccard(left: list[str], right: list[str], words: int = WORDS) -> np.ndarray:
    """Sum of smaller over sum of larger shingle counts, pair by pair; 1 where neither text has words."""
    n = len(left)
    hashes, starts = word_hashes(left + right)
    shingles, owner = shingle_hashes(hashes, starts, words)
    side, pair = owner >= n, owner % max(n, 1)
    o, s, count = multisets(shingles, pair * 2 + side)
    order = np.lexsort((s, o // 2))
    o, s, count = o[order], s[order], count[order]
    both = np.flatnonzero((o[1:] // 2 == o[:-1] // 2) & (s[1:] == s[:-1]))
    smaller = np.bincount(o[both] // 2, weights=np.minimum(count[both], count[both + 1]), minlength=n)
    total = np.bincount(o // 2, weights=count, minlength=n)
    return np.where(total == 0, 1.0, smaller / np.maximum(total - smaller, 1))
