"""Byte-pair merges of many words at once, in numpy.

All symbols of all words lie in one flat array with the word each belongs to. Every round finds the
rank of each neighbouring pair by binary search over the sorted pair keys, takes each word's lowest
rank, merges all its occurrences together (from the left, never overlapping), and drops the words that
have no pair left. Merging all occurrences in a round equals merging them one by one, because a
merge's product is made by no other merge, so nothing of a lower rank can come up in between; the
table refuses a vocabulary in which that fails.

A round costs as much as the symbols it holds, and a word may need a round per rank. So a word of more than
``LONG_WORD`` bytes goes another way to the same ids: its pairs wait in a queue ordered by rank and place, and a
merge renews only the two pairs beside it.
"""

from __future__ import annotations

import json
from functools import cache, cached_property
from heapq import heappop, heappush

import numpy as np
import regex

from driftwell.llm.codes import ragged

NO_RANK = np.int64(1) << 40
CACHED_WORDS = 200_000
LONG_WORD = 512
SHIFT = np.int64(32)


@cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shown, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in shown:
            shown[b], spare = chr(spare), spare + 1
    return [shown[b] for b in range(256)]


class Merges:
    """The merge table and the vocabulary of a byte-level BPE file of the tokenizers format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if len({a + b for a, b in pairs}) != len(pairs):
            raise ValueError("two merges have one product")
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = (left << SHIFT) | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """(is special, part) of a text; special strings stand for their own tokens."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [(False, text)]
        return [(part in self.special, part) for part in self.special_pattern.split(text) if part]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has. No word may be empty."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        short = np.fromiter((len(w) <= LONG_WORD for w in raw), dtype=bool, count=len(raw))
        if short.all():
            return self._rounds(raw)
        ids, few = self._rounds([w for w in raw if len(w) <= LONG_WORD])
        queued = {i: self._queued(raw[i]) for i in np.flatnonzero(~short).tolist()}
        counts = np.empty(len(raw), np.int64)
        counts[short], counts[~short] = few, [len(found) for found in queued.values()]
        starts = np.cumsum(counts) - counts
        whole = np.empty(int(counts.sum()), np.int64)
        whole[ragged(starts[short], few)] = ids
        for i, found in queued.items():
            whole[starts[i] : starts[i] + len(found)] = found
        return whole, counts

    @cached_property
    def _products(self) -> dict[int, tuple[int, int]]:
        """Pair key to (rank, product)."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))

    def _queued(self, word: bytes) -> list[int]:
        """Ids of one long word."""
        data = np.frombuffer(word, dtype=np.uint8)
        symbols, n = self.inner[data], len(data)
        symbols[-1] = self.last[data[-1]]
        keys = (symbols[:-1] << SHIFT) | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        places = np.flatnonzero(self.keys[at] == keys)
        # A sorted list is a heap. Entries are rank and place in one number.
        waiting = np.sort((self.ranks[at[places]] << SHIFT) | places).tolist()
        held, products, shift, place = symbols.tolist(), self._products, int(SHIFT), (1 << int(SHIFT)) - 1
        held.append(-1)  # merged symbols and the end are negative, so they are in no pair
        after, before = list(range(1, n + 2)), list(range(-1, n))
        while waiting:
            entry = heappop(waiting)
            here = entry & place
            there = after[here]
            if held[here] < 0 or there >= n:
                continue
            merge = products.get((held[here] << shift) | held[there])
            if merge is None or merge[0] != entry >> shift:
                continue  # the pair is another one by now
            made = held[here] = merge[1]
            held[there] = -1
            right = after[here] = after[there]
            before[right] = here
            if right < n and (merge := products.get((made << shift) | held[right])):
                heappush(waiting, (merge[0] << shift) | here)
            left = before[here]
            if left >= 0 and (merge := products.get((held[left] << shift) | made)):
                heappush(waiting, (merge[0] << shift) | left)
        return [symbol for symbol in held if symbol >= 0]

    def _rounds(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        if not len(raw):
            return np.empty(0, np.int64), lengths
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols, ends = self.inner[data], np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(raw)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            keys = (symbols[:-1] << SHIFT) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
            rank = np.where(found, self.ranks[at], NO_RANK)
            lowest = np.full(len(raw), NO_RANK)
            np.minimum.at(lowest, owner[:-1][found], rank[found])
            open_ = lowest[owner] < NO_RANK
            if not open_.all():
                done.append((owner[~open_], symbols[~open_]))
            chosen = found & (rank == lowest[owner[:-1]])
            starts = np.flatnonzero(chosen)
            if len(starts) == 0:
                break
            # Of a run of chosen neighbours (a pair of equal symbols) every second one merges.
            fresh = np.concatenate(([True], np.diff(starts) > 1))
            run_start = starts[np.maximum.accumulate(np.where(fresh, np.arange(len(starts)), 0))]
            starts = starts[(starts - run_start) % 2 == 0]
            symbols[starts] = self.made[at[starts]]
            open_[starts + 1] = False
            symbols, owner = symbols[open_], owner[open_]
        owners = np.concatenate([o for o, _ in done])
        order = np.argsort(owners, kind="stable")
        return np.concatenate([s for _, s in done])[order], np.bincount(owners, minlength=len(raw))


@cache
def load(path: str) -> Merges:
    return Merges(path)


class WordStore:
    """Ids of words met so far in this task; emptied when it holds too many."""

    def __init__(self, merges: Merges, limit: int = CACHED_WORDS):
        self.merges, self.limit = merges, limit
        self._clear()

    def _clear(self) -> None:
        # The first places belong to the special tokens.
        special = sorted(self.merges.special.items())
        self.place = {f"\0{text}": i for i, (text, _) in enumerate(special)}
        self.ids = np.array([i for _, i in special], dtype=np.int64)
        self.lengths = np.ones(len(special), dtype=np.int64)

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each word; special tokens are asked for with a zero byte before them."""
        new = list(set(words).difference(self.place))
        if len(self.place) + len(new) > self.limit:
            self._clear()
            new = list(set(words).difference(self.place))
        if new:
            ids, lengths = self.merges.encode(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.ids = np.concatenate((self.ids, ids))
            self.lengths = np.concatenate((self.lengths, lengths))
        return np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))

    def flat_ids(self, places: np.ndarray) -> np.ndarray:
        starts = np.cumsum(self.lengths) - self.lengths
        return self.ids[ragged(starts[places], self.lengths[places])]
