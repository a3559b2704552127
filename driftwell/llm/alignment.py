"""Two tokenizers' tokens of the same texts, aligned by bytes, and the links between their ids weighed over the corpus.

A is a byte-level vocabulary (tokenizers format) and reads a space and the text, special strings as plain text; B is a
sentence-piece model that adds that space itself. Byte offsets where tokens of both end cut a text into groups; all A
and B tokens of a group are linked. The count of an id pair is the number of documents that hold it linked.

* Both vocabularies cut between anything but white space and a space, and so do the groups. A text is therefore a
  sequence of units (a space and what follows up to the next such place); a unit met before in the task is not
  tokenized or aligned again. (The B model is refused if a piece goes on over such a place.)
* ``identity[a]`` is the B id with the same bytes as A's id a, worked out from the vocabularies. Nearly all groups
  are one A token and one B token of that pair; they are counted in vectors as long as the vocabulary, one a task,
  whose sum has a row per id. Only pairs of other groups are shuffled as pairs, one row per document and pair,
  combined before the shuffle.
* To weigh the links, the counts of identity pairs, the highest count of each A id (both bounded by the
  vocabulary) and those of the ``COMMON`` most frequent other pairs go to the tasks. Pairs that are rarer are joined;
  each of these has few rows, so no key is hot.

Null and empty texts, and texts whose tokens' joined bytes differ from a space and the text in A or B (the text has
U+2581, say), have no tokens: zeros and an empty list of groups. Texts of any length are fine: a run of whole
texts of about a million code points and the units known so far are held. Repeated rows are documents of their own. Ties:
all links with the highest count are best. An empty table gives no rows; the columns named in ``kept`` are handed on.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.codes import ragged, runs, small_batches
from driftwell.llm.merges import byte_symbols
from driftwell.session import materialize, scratch

COMMON = 65_536
KNOWN_UNITS = 100_000
KNOWN_CHARS = 1 << 23
PAIRS_AT_ONCE = 1 << 21
JOINED_CHARS = 1 << 15  # of units that A reads as one text
BITS = np.int64(20)  # of an id
MASK = (1 << 20) - 1

_CUT = re.compile(r"(?<=\S)(?= )")
_BLANK_BEFORE_SPACE = re.compile(r"\s ")

ALIGNED = "struct<n_a:long,n_b:long,n_groups:long,n_links:long,groups:string,same:array<int>,same_times:array<long>,odd_a:array<int>,odd_b:array<int>,odd_times:array<long>>"


def units_of(text: str) -> list[str]:
    """The units of a space and ``text``, each without the space it starts with."""
    full = " " + text
    if _BLANK_BEFORE_SPACE.search(full) is None:
        return text.split(" ")
    return [unit[1:] for unit in _CUT.split(full)]


class Vocabularies:
    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        if not all(symbol in vocabulary for symbol in byte_of):
            raise ValueError("A does not know every byte")
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(x != "▁" and y == "▁" for piece in pieces for x, y in zip(piece, piece[1:], strict=False)):
            raise ValueError("a piece goes on over a space")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.length_a, self.length_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.written = [np.array([[f"{i}{sign}" for i in range(n)] for sign in signs], dtype=object) for n, signs in ((len(self.bytes_a), ",|"), (len(pieces), ",;"))]
        by_bytes: dict[bytes, int] = {}
        for byte_piece in (False, True):  # a whole piece before a single byte
            for i, own in enumerate(self.bytes_b):
                if self.b.is_byte(i) == byte_piece and not self.b.is_control(i) and not self.b.is_unknown(i):
                    by_bytes.setdefault(own, i)
        self.identity = np.fromiter((by_bytes.get(own, -1) for own in self.bytes_a), np.int64, len(self.bytes_a))

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For units given without their first space: ids in A, how many each unit has, the same in B; none where bytes differ."""
        own = [b" " + u.encode("utf-8", "surrogatepass") for u in units]
        size = np.fromiter(map(len, own), np.int64, len(own))
        in_a = self._in_a(units)
        in_b = [ids or [self.space] for ids in self.b.encode(units, num_threads=1)]
        n_b = np.fromiter(map(len, in_b), np.int64, len(in_b))
        b = np.fromiter(chain.from_iterable(in_b), np.int64, int(n_b.sum()))
        # A's vocabulary has every byte, so its bytes are the units' own, and a unit ends where its bytes do.
        upto = np.searchsorted(np.cumsum(self.length_a[in_a]), np.cumsum(size)) + 1
        n_a = np.diff(upto, prepend=0)
        fits = np.add.reduceat(self.length_b[b], np.cumsum(n_b) - n_b) == size if len(units) else np.empty(0, bool)
        kept = np.repeat(fits, n_b)
        if b"".join(map(self.bytes_b.__getitem__, b[kept].tolist())) != b"".join([o for o, f in zip(own, fits.tolist(), strict=True) if f]):
            fits &= np.fromiter((b"".join(map(self.bytes_b.__getitem__, ids)) == o for ids, o in zip(in_b, own, strict=True)), bool, len(own))
            kept = np.repeat(fits, n_b)
        return in_a[np.repeat(fits, n_a)], np.where(fits, n_a, 0), b[kept], np.where(fits, n_b, 0)

    def _in_a(self, units: list[str]) -> np.ndarray:
        """Ids of all units one after the other. Those that end in a letter or sign are joined, as nothing reaches over their ends."""
        texts, held, size = [], [], 0
        for unit in units:
            held += (" ", unit)
            size += len(unit)
            if size >= JOINED_CHARS or not unit or unit[-1].isspace():
                texts.append("".join(held))
                held, size = [], 0
        texts.append("".join(held))
        return np.concatenate([np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])


@cache
def load(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times, first)


class Units:
    """Alignments of the units met so far in this task; emptied when they are too many."""

    def __init__(self, vocabularies: Vocabularies):
        self.of = vocabularies
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.shown: list[str] = []
        self.chars = 0
        self.numbers = np.empty((4, 0), np.int64)  # n_a, n_b, n_groups, n_links
        self.pair, self.times, self.pairs = (np.empty(0, np.int64) for _ in range(3))

    def places(self, units: list[str]) -> np.ndarray:
        new = list(set(units).difference(self.place))
        if len(self.place) + len(new) > KNOWN_UNITS or self.chars > KNOWN_CHARS:
            self._clear()
            new = list(set(units))
        if new:
            self._align(new)
        return np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))

    def _align(self, new: list[str]) -> None:
        a, n_a, b, n_b = self.of.encode(new)
        # Units without tokens have no bytes here either, so that both sides' offsets are the same line.
        end_a, end_b = np.cumsum(self.of.length_a[a]), np.cumsum(self.of.length_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        unit_of_a = np.repeat(np.arange(len(new)), n_a)
        unit_of_group = unit_of_a[np.searchsorted(group_a, np.arange(len(ends)))] if len(ends) else np.empty(0, np.int64)
        in_group_a, in_group_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        links = np.bincount(unit_of_group, weights=in_group_a * in_group_b, minlength=len(new)).astype(np.int64)
        groups = np.bincount(unit_of_group, minlength=len(new))
        self._show(a, b, group_a, group_b, n_a + n_b)
        self._pair(len(new), a, b, group_a, group_b, unit_of_group, len(ends))
        self.numbers = np.concatenate((self.numbers, np.stack([n_a, n_b, groups, links])), axis=1)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.chars += sum(map(len, new))

    def _show(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, tokens: np.ndarray) -> None:
        """Every unit's groups as text: each id with the sign behind it, in the order of groups, A's before B's."""
        last_a, last_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
        written = np.concatenate((self.of.written[0][last_a.astype(int), a], self.of.written[1][last_b.astype(int), b]))
        written = written[np.argsort(np.concatenate((group_a, group_b)), kind="stable")].tolist()
        at = 0
        for n in tokens.tolist():
            self.shown.append("".join(written[at : at + n])[:-1])
            at += n

    def _pair(self, n, a, b, group_a, group_b, unit_of_group, n_groups) -> None:
        """Distinct linked pairs of every unit, with how often each is linked."""
        ones = np.ones(1, np.int64)
        key_a, times_a = _counted(group_a << BITS | a, np.broadcast_to(ones, a.shape))
        key_b, times_b = _counted(group_b << BITS | b, np.broadcast_to(ones, b.shape))
        of_a, of_b = key_a >> BITS, key_b >> BITS
        partners = np.bincount(of_b, minlength=n_groups)[of_a]
        first = np.searchsorted(of_b, of_a)
        keys, times, units = [], [], []
        upto, at = np.cumsum(partners), 0
        while at < len(key_a):
            until = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            some = slice(at, until)
            left, right = np.repeat(np.arange(at, until), partners[some]), ragged(first[some], partners[some])
            unit = unit_of_group[of_a[left]]
            key = (key_a[left] & MASK) << BITS | (key_b[right] & MASK)
            order = np.lexsort((key, unit))
            unit, key, number = unit[order], key[order], (times_a[left] * times_b[right])[order]
            fresh = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (key[1:] != key[:-1])))) if len(key) else np.empty(0, np.int64)
            keys.append(key[fresh])
            units.append(unit[fresh])
            times.append(np.add.reduceat(number, fresh) if len(fresh) else number)
            at = until
        none = np.empty(0, np.int64)
        self.pair = np.concatenate([self.pair, *keys])  # in the order of units; a unit cut by the loop may have a pair twice
        self.times = np.concatenate([self.times, *times])
        self.pairs = np.concatenate([self.pairs, np.bincount(np.concatenate([none, *units]), minlength=n)])


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values).cast(kind))


def _run(store: Units, texts: list[str]) -> pa.StructArray:
    """The alignments of some whole texts."""
    units = [units_of(t) if t else [] for t in texts]
    n_units = np.fromiter(map(len, units), np.int64, len(units))
    places = store.places([u for doc in units for u in doc])
    doc = np.repeat(np.arange(len(texts)), n_units)
    whole = np.bincount(doc, weights=store.numbers[0][places] == 0, minlength=len(texts)) == 0
    places, doc = places[whole[doc]], doc[whole[doc]]
    numbers = [np.bincount(doc, weights=row[places], minlength=len(texts)).astype(np.int64) for row in store.numbers]
    upto = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))
    shown = [store.shown[p] for p in places.tolist()]
    groups = [";".join(shown[x:y]) for x, y in zip(upto, upto[1:], strict=False)]
    starts = np.cumsum(store.pairs) - store.pairs
    at = ragged(starts[places], store.pairs[places])
    owner = np.repeat(doc, store.pairs[places])
    order = np.lexsort((store.pair[at], owner))
    owner, key, times = owner[order], store.pair[at][order], store.times[at][order]
    fresh = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])))) if len(key) else np.empty(0, np.int64)
    owner, key, times = owner[fresh], key[fresh], np.add.reduceat(times, fresh) if len(fresh) else times
    a, b = key >> BITS, key & MASK
    same = store.of.identity[a] == b
    ends = [np.concatenate(([0], np.cumsum(np.bincount(owner[kind], minlength=len(texts))))) for kind in (same, ~same)]
    lists = [_lists(ends[0], a[same], pa.int32()), _lists(ends[0], times[same], pa.int64()), _lists(ends[1], a[~same], pa.int32()), _lists(ends[1], b[~same], pa.int32()), _lists(ends[1], times[~same], pa.int64())]
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "same", "same_times", "odd_a", "odd_b", "odd_times"]
    return pa.StructArray.from_arrays([*map(pa.array, numbers), pa.array(groups, pa.string()), *lists], names=names)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", out: str = "aligned") -> DataFrame:
    """Adds the struct ``out``: numbers of tokens, groups and links, ``groups`` as ``a1,a2|b1;a3|b2``, and the linked pairs.

    Pairs of the identity map are in ``same`` (their A ids), the others in ``odd_a`` and ``odd_b``; ``*_times`` says
    how often the text links each.
    """
    small_batches(df.sparkSession)

    @F.arrow_udf(ALIGNED)
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = Units(load(path_a, path_b))
        for batch in batches:
            made = [_run(store, texts) for texts in runs(batch.to_pylist())]
            yield pa.concat_arrays(made or [_run(store, [])])

    return df.withColumn(out, aligned(F.col(f"`{text}`")))


def _same_counts(aligned: DataFrame, size: int) -> DataFrame:
    """(a, n): documents that link A's id a to its identity, for ids that are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("same").flatten().to_numpy(zero_copy_only=False), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["a", "n"])

    return aligned.select("same").mapInArrow(counted, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _vector(rows: list, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r.a] = r.n
    return out


def weigh(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Of rows of a unique ``row`` with the pair columns of ``align``: (row, n_best, count_sum). ``aligned`` is read several times."""
    spark = aligned.sparkSession
    size = len(load(path_a, path_b).identity)
    same = materialize(_same_counts(aligned, size), "same-counts")
    pairs = aligned.select(F.inline(F.arrays_zip("odd_a", "odd_b"))).toDF("a", "b")
    odd = materialize(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "odd-counts")
    most = same.unionByName(odd.select(F.col("a").cast("long").alias("a"), "n")).groupBy("a").agg(F.max("n").alias("n"))
    # No more than COMMON pairs can have this share of all.
    share = (odd.agg(F.sum("n")).first()[0] or 0) / COMMON
    common = odd.filter(F.col("n") >= F.lit(share)).collect()
    keys = np.array([(r.a << int(BITS)) | r.b for r in common], dtype=np.int64)
    order = np.argsort(keys)
    vectors = (_vector(same.collect(), size), _vector(most.collect(), size))
    shared = spark.sparkContext.broadcast((*vectors, keys[order], np.array([r.n for r in common], dtype=np.int64)[order]))

    @F.arrow_udf("struct<n_best:long,count_sum:long,rare:array<struct<a:int,b:int,times:long>>>")
    def known(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        same_n, most_n, common_keys, common_n = shared.value
        for lists in batches:
            rows = len(lists[0])
            a, times, odd_a, odd_b, odd_times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            owner, odd_owner = (np.repeat(np.arange(rows), x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) for x in (lists[0], lists[2]))
            key = odd_a << BITS | odd_b
            at = np.minimum(np.searchsorted(common_keys, key), max(len(common_keys) - 1, 0))
            met = common_keys[at] == key if len(common_keys) else np.zeros(len(key), bool)
            own = np.concatenate((owner, odd_owner[met]))
            number = np.concatenate((times, odd_times[met]))
            count = np.concatenate((same_n[a], common_n[at[met]] if met.any() else np.empty(0, np.int64)))
            is_best = count == most_n[np.concatenate((a, odd_a[met]))]
            best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(best, own, number * is_best)
            np.add.at(total, own, number * count)
            ends = np.concatenate(([0], np.cumsum(np.bincount(odd_owner[~met], minlength=rows)))).astype(np.int32)
            fields = [pa.array(odd_a[~met]).cast(pa.int32()), pa.array(odd_b[~met]).cast(pa.int32()), pa.array(odd_times[~met])]
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names=["a", "b", "times"]))
            yield pa.StructArray.from_arrays([pa.array(best), pa.array(total), rare], names=["n_best", "count_sum", "rare"])

    weighed = materialize(aligned.select("row", known("same", "same_times", "odd_a", "odd_b", "odd_times").alias("w")).select("row", "w.*"), "weighed")
    rare = weighed.select("row", F.inline("rare")).join(odd, ["a", "b"])
    best = F.broadcast(most.select(F.col("a").alias("most_a"), F.col("n").alias("most_n")))  # a row per A id at most
    rare = rare.join(best, F.col("a") == F.col("most_a"))
    of_rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("most_n"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum")
    )
    joined = weighed.drop("rare").join(of_rare, "row", "left")
    return joined.select("row", *[(F.col(c) + F.coalesce(r, F.lit(0))).alias(c) for c, r in (("n_best", "rare_best"), ("count_sum", "rare_sum"))])


def weighed_alignments(df: DataFrame, path_a: str, path_b: str, text: str = "text", kept: list[str] | None = None) -> DataFrame:
    """The ``kept`` columns and n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    kept = kept or []
    own = df.select(*[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").alias("text"))
    with scratch(df.sparkSession) as keep:
        found = align(own, path_a, path_b).drop("text").select("*", "aligned.*").drop("aligned")
        digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
        found = found.withColumn("groups_sha256", digest).drop("groups").withColumn("row", F.monotonically_increasing_id())
        found = materialize(found, "aligned")
        numbers = ["n_a", "n_b", "n_groups", "n_links"]
        plain = found.select("row", *[f"kept_{i}" for i in range(len(kept))], *numbers, "groups_sha256")
        both = plain.join(weigh(found, path_a, path_b), "row")
        return keep(both.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(kept)], *numbers, "n_best", "count_sum", "groups_sha256"), "alignments")
