"""BagMinHash signatures of many weighted sets at once (numpy, for Arrow UDFs).

A weight w stands for the levels 1..w. Every (element, level) carries a Poisson process of rate 1 whose
points each fall on a random register; a register keeps the earliest point of all levels its set has, and
two sets agree in a register with the probability of their weighted Jaccard similarity. Levels are not
walked one by one: (0, 1], (1, 2], (2, 4], ... each have a process of their width's rate, known by its
first point. It splits in halves: the half holding the point inherits it, the other one draws its own
first point after it. Halves beyond the weight, and processes whose first point comes after the set's
latest register, are dropped unseen, so that a set costs about as many points as its registers need.
"""

from __future__ import annotations

import numpy as np

from driftwell.llm.codes import U64, mix

REGISTERS = 160


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _wait(bits: np.ndarray, rate: np.ndarray | float) -> np.ndarray:
    return -np.log(_uniform(bits)) / rate


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """(n, registers) earliest points. Sets without elements keep infinity."""
    total = np.bincount(owner, weights=weights, minlength=n)
    out = np.full((n, registers), np.inf)
    todo, factor = np.flatnonzero(total > 0), 1.0
    while len(todo):
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        mine = place[owner] >= 0
        # All registers are very likely filled by this time; sets with an empty one run again, longer.
        limit = factor * registers * (np.log(registers) + 6.0) / total[todo]
        found = _points(place[owner[mine]], elements[mine], weights[mine], limit, registers)
        full = np.isfinite(found).all(axis=1)
        out[todo[full]] = found[full]
        todo, factor = todo[~full], factor * 4.0
    return out


def _points(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, limit: np.ndarray, registers: int) -> np.ndarray:
    found = np.full((len(limit), registers), np.inf)
    flat = found.reshape(-1)
    with np.errstate(over="ignore"):
        # Root intervals (0, 1], (1, 2], (2, 4], ... up to the weight.
        roots = 1 + np.ceil(np.log2(weights)).astype(np.int64)
        of = np.repeat(np.arange(len(owner)), roots)
        q = np.arange(len(of)) - np.repeat(np.cumsum(roots) - roots, roots)
        doc, weight = owner[of], weights[of]
        low = np.where(q == 0, 0, np.int64(1) << np.maximum(q - 1, 0))
        width = np.where(q <= 1, 1, np.int64(1) << np.maximum(q - 1, 0))
        seed = mix(elements[of] ^ mix(q.astype(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(1)))
        time = _wait(mix(seed + U64(1)), width)
        latest = limit.copy()
        while len(doc):
            keep = (time <= latest[doc]) & (low < weight)
            doc, weight, low, width, seed, time = doc[keep], weight[keep], low[keep], width[keep], seed[keep], time[keep]
            single = width == 1
            at = doc[single] * registers + (mix(seed[single] + U64(2)) % U64(registers)).astype(np.int64)
            np.minimum.at(flat, at, time[single])
            latest = np.minimum(limit, found.max(axis=1))
            # A single level goes on to its next point.
            next_seed = mix(seed[single] + U64(3))
            next_time = time[single] + _wait(mix(next_seed + U64(1)), 1.0)
            # A wider interval splits in halves.
            wide = ~single
            half = width[wide] // 2
            right_first = (mix(seed[wide] + U64(4)) >> U64(63)).astype(bool)
            left_seed, right_seed = mix(seed[wide] + U64(5)), mix(seed[wide] + U64(6))
            late = time[wide] + _wait(mix(np.where(right_first, left_seed, right_seed) + U64(1)), np.maximum(half, 1))
            left_time, right_time = np.where(right_first, late, time[wide]), np.where(right_first, time[wide], late)
            doc = np.concatenate((doc[single], doc[wide], doc[wide]))
            weight = np.concatenate((weight[single], weight[wide], weight[wide]))
            low = np.concatenate((low[single], low[wide], low[wide] + half))
            width = np.concatenate((width[single], half, half))
            seed = np.concatenate((next_seed, left_seed, right_seed))
            time = np.concatenate((next_time, left_time, right_time))
    return found


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(n, bands) hashes of as many equal groups of registers; the band's number is part of the hash."""
    n, registers = signature.shape
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(n, bands, registers // bands)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15), (n, bands))
        for k in range(bits.shape[2]):
            keys = mix(keys ^ mix(bits[:, :, k] + U64(k + 1)))
    return keys


def sketches(signature: np.ndarray, planes: int = 4, words: int = 4) -> np.ndarray:
    """(n, words * planes): four hashed bits of every register, bit by bit, the registers dealt to ``words`` words."""
    bits = mix(np.ascontiguousarray(signature).view(np.uint64)).reshape(len(signature), words, -1)
    powers = U64(1) << np.arange(bits.shape[2], dtype=np.uint64)
    made = [((bits[:, w] >> U64(63 - p) & U64(1)) * powers).sum(axis=1, dtype=np.uint64) for w in range(words) for p in range(planes)]
    return np.stack(made, axis=1)
