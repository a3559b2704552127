"""Vectors compressed to short codes: each part of a vector is named by the nearest entry of its codebook.

Components become whole numbers (see ``vectors``), a vector is cut into ``parts`` equal consecutive parts, and
every part position has a codebook. It starts as that part of the smallest ids; each round assigns every part
of every vector to its nearest entry (squared Euclidean distance, ties to the lower index) and replaces an
entry by the rounded-down mean of its parts; unused entries stay. Nothing is sampled: all rounds see all rows.

Exact assignment without comparing everything with everything:

* A task packs its vectors into chunks. In a chunk the parts of each position are sorted along a Hilbert curve
  and cut into flat blocks of ``BLOCK`` parts, each with its box (least and largest components) and sum. The
  chunks are written once, and every round reads them; no row is shuffled.
* In a round the distances between boxes and entries give every block a shortlist: an entry whose nearest
  point of the box is further than another one's farthest can't be anyone's nearest there. A block with one
  entry left adds its stored sum unseen; the others are decided by integer kernels over shortlist and parts.
* A task adds up its blocks; what is shuffled is one row per entry component and task, and the codebooks
  (``parts`` * ``entries`` entries whatever the number of rows) go to the tasks with the next round.

Rows whose vector is null or holds null or non-finite components are dropped. Vectors of different lengths
have codebooks of their own; a length that the parts do not divide is filled up with zeros. Null ids come
last, rows of equal ids in the order of their vectors; repeated rows count as often as they are there. With
fewer rows than entries the codebook is as small as the rows. An empty table gives no rows. Other columns
are not read, and null labels are one label.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from driftwell.llm.vectors import padded, usable, whole_numbers
from driftwell.session import materialize, scratch

PARTS, ENTRIES, ROUNDS, FACTOR = 16, 64, 2, 256
BLOCK = 32  # parts in a block
CHUNK = 16_384  # vectors in a chunk
CHUNK_NUMBERS = 1 << 20  # components in a chunk
CURVE_BITS = 10


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each row of ``points`` on a Hilbert curve through their box (Skilling's transform)."""
    n, width = points.shape
    if n == 0 or width == 0:
        return np.zeros(n, np.uint64)
    bits = max(1, min(CURVE_BITS, 62 // width))
    low, high = points.min(axis=0), points.max(axis=0)
    shift = max(0, int((high.astype(np.int64) - low).max()).bit_length() - bits)
    axes = [((points[:, i].astype(np.int64) - low[i]) >> shift).astype(np.uint64) for i in range(min(width, 62))]
    one, top = np.uint64(1), 1 << (bits - 1)
    q = top
    while q > 1:
        mask = np.uint64(q - 1)
        for i, axis in enumerate(axes):
            hit = (axis & np.uint64(q)) != 0
            swap = np.where(hit, np.uint64(0), (axes[0] ^ axis) & mask)
            axes[0] ^= np.where(hit, mask, swap)
            if i:
                axis ^= swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn, q = np.zeros(n, np.uint64), top
    while q > 1:
        turn ^= np.where((axes[-1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    keys = np.zeros(n, np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << one) | (((axis ^ turn) >> np.uint64(bit)) & one)
    return keys


def pack(numbers: np.ndarray, parts: int) -> dict[str, bytes]:
    """The blocks of one chunk; ``numbers`` has a vector per row. Sorted parts, their order, boxes and sums."""
    n, dims = numbers.shape
    width = dims // parts
    cut = numbers.reshape(n, parts, width).transpose(1, 0, 2)
    order = np.stack([np.argsort(hilbert_keys(p), kind="stable") for p in cut]).astype(np.int32)
    ordered = np.take_along_axis(cut, order[:, :, None].astype(np.int64), axis=1)
    starts = np.arange(0, n, BLOCK)
    sums = np.add.reduceat(ordered.astype(np.int64), starts, axis=1)
    low, high = np.minimum.reduceat(ordered, starts, axis=1), np.maximum.reduceat(ordered, starts, axis=1)
    return {"ordered": ordered.tobytes(), "place": order.tobytes(), "low": low.tobytes(), "high": high.tobytes(), "sums": sums.tobytes()}


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(blocks, entries): which entries may be nearest to a point of the block's box."""
    low, high = low[:, None].astype(np.int64), high[:, None].astype(np.int64)
    outside = np.maximum(np.maximum(low - book, book - high), 0)
    across = np.maximum(np.abs(book - low), np.abs(high - book))
    return (outside**2).sum(axis=2) <= (across**2).sum(axis=2).min(axis=1)[:, None]


def nearest_entries(points: np.ndarray, blocks: np.ndarray, listed: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, BLOCK) entry and squared distance of the points of some blocks, each against its shortlist.

    The last block is filled up with its last point.
    """
    at = np.minimum(blocks[:, None] * BLOCK + np.arange(BLOCK), len(points) - 1)
    block, entry = np.nonzero(listed)
    distance = ((points[at].astype(np.int64)[block] - book[entry][:, None]) ** 2).sum(axis=2)
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    least = np.minimum.reduceat(distance, starts, axis=0)
    first = np.where(distance == least[block], entry[:, None], len(book))
    return np.minimum.reduceat(first, starts, axis=0), least


class _Chunk:
    def __init__(self, row: dict, parts: int):
        self.n, width = len(row["id"]), row["dims"] // parts
        blocks = -(-self.n // BLOCK)
        self.ordered = np.frombuffer(row["ordered"], np.int32).reshape(parts, self.n, width)
        self.place = np.frombuffer(row["place"], np.int32).reshape(parts, self.n)
        self.low, self.high = (np.frombuffer(row[c], np.int32).reshape(parts, blocks, width) for c in ("low", "high"))
        self.sums = np.frombuffer(row["sums"], np.int64).reshape(parts, blocks, width)
        self.sizes = np.minimum(BLOCK, self.n - np.arange(blocks) * BLOCK)

    def totals(self, part: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the parts nearest to each entry."""
        listed = shortlists(self.low[part], self.high[part], book)
        alone = listed.sum(axis=1) == 1
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        settled = listed[alone].argmax(axis=1)
        np.add.at(sums, settled, self.sums[part][alone])
        np.add.at(counts, settled, self.sizes[alone])
        open_ = np.flatnonzero(~alone)
        if len(open_):
            entry, _ = nearest_entries(self.ordered[part], open_, listed[open_], book)
            real = np.arange(BLOCK) < self.sizes[open_][:, None]
            at = (open_[:, None] * BLOCK + np.arange(BLOCK))[real]
            np.add.at(sums, entry[real], self.ordered[part][at].astype(np.int64))
            counts += np.bincount(entry[real], minlength=len(book))
        return sums, counts

    def codes(self, part: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of this part of every vector, in the chunk's own order."""
        listed = shortlists(self.low[part], self.high[part], book)
        entry, distance = nearest_entries(self.ordered[part], np.arange(len(listed)), listed, book)
        out = np.empty((2, self.n), np.int64)
        out[:, self.place[part]] = entry.reshape(-1)[: self.n], distance.reshape(-1)[: self.n]
        return out[0], out[1]


def _chunks(rows: DataFrame, parts: int, factor: int) -> DataFrame:
    types = {f.name: f.dataType for f in rows.schema}
    lists = [StructField("id", ArrayType(types["id"])), StructField("label", ArrayType(types["label"]))]
    blobs = [StructField(c, BinaryType()) for c in ("ordered", "place", "low", "high", "sums")]
    schema = StructType([StructField("dims", IntegerType()), *lists, *blobs])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = defaultdict(list)
        sizes: dict[int, int] = defaultdict(int)

        def chunk(dims: int) -> pa.RecordBatch:
            ids, labels, numbers = zip(*held.pop(dims), strict=True)
            sizes.pop(dims)
            made = {"dims": pa.array([dims], pa.int32())}
            for name, pieces in (("id", ids), ("label", labels)):
                values = pa.concat_arrays(pieces)
                made[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            for name, blob in pack(np.concatenate(numbers), parts).items():
                made[name] = pa.array([blob], pa.binary())
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            values, lengths = whole_numbers(batch.column("vector"), factor)
            ends = np.cumsum(lengths)
            for length in np.unique(lengths):
                here, dims = np.flatnonzero(lengths == length), int(-(-length // parts) * parts)
                most = max(1, min(CHUNK, CHUNK_NUMBERS // max(dims, 1)))
                for some in np.array_split(here, -(-len(here) // most)):
                    flat = values[(ends[some] - length)[:, None] + np.arange(length)].reshape(-1)
                    held[dims].append((batch.column("id").take(pa.array(some)), batch.column("label").take(pa.array(some)), padded(flat, lengths[some], dims)))
                    sizes[dims] += len(some)
                    if sizes[dims] >= most:
                        yield chunk(dims)
        for dims in list(held):
            yield chunk(dims)

    return materialize(rows.mapInArrow(packed, schema), "chunks")


def _first_books(rows: DataFrame, parts: int, entries: int, factor: int) -> dict[int, np.ndarray]:
    """For every (filled-up) length: (parts, entries, width) from its smallest ids."""
    dims = F.ceil(F.size("vector") / parts).cast("int") * parts
    place = F.row_number().over(Window.partitionBy("dims").orderBy(F.col("id").asc_nulls_last(), "vector"))
    first = rows.select("id", "vector", dims.alias("dims")).withColumn("place", place).filter(F.col("place") <= entries)
    found = defaultdict(list)
    for row in sorted(first.select("dims", "place", "vector").collect(), key=lambda r: r.place):
        found[row.dims].append(row.vector)
    books = {}
    for size, vectors in found.items():
        values, lengths = whole_numbers(pa.array(vectors, pa.list_(pa.float64())), factor)
        books[size] = padded(values, lengths, size).astype(np.int64).reshape(len(vectors), parts, -1).transpose(1, 0, 2)
    return books


def _improved(chunks: DataFrame, books: dict[int, np.ndarray], parts: int) -> dict[int, np.ndarray]:
    """One round over all chunks."""
    shared = chunks.sparkSession.sparkContext.broadcast(books)  # parts * entries entries for each length

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums = {d: np.zeros(b.shape, np.int64) for d, b in known.items()}
        counts = {d: np.zeros(b.shape[:2], np.int64) for d, b in known.items()}
        for batch in batches:
            for row in batch.to_pylist():
                chunk, dims = _Chunk(row, parts), row["dims"]
                for part in range(parts):
                    added, number = chunk.totals(part, known[dims][part])
                    sums[dims][part] += added
                    counts[dims][part] += number
        for dims in known:
            part, entry = np.nonzero(counts[dims])
            for component in range(sums[dims].shape[2]):
                columns = [np.full(len(part), dims), part, entry, np.full(len(part), component), sums[dims][part, entry, component], counts[dims][part, entry]]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["dims", "part", "entry", "component", "total", "n"])

    schema = "dims long, part long, entry long, component long, total long, n long"
    found = chunks.mapInArrow(totals, schema).groupBy("dims", "part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    better = {d: b.copy() for d, b in books.items()}
    for r in found.collect():
        better[r.dims][r.part, r.entry, r.component] = r.total // r.n
    shared.unpersist()
    return better


def _digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def _coded(chunks: DataFrame, books: dict[int, np.ndarray], parts: int, id_type, label_type) -> DataFrame:
    shared = chunks.sparkSession.sparkContext.broadcast((books, {d: _digest(b) for d, b in books.items()}))
    schema = StructType([StructField("id", id_type), StructField("label", label_type)]).add("code", "string").add("error", "long").add("codebooks_sha256", "string")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, digests = shared.value
        hexed = np.array([f"{i:02x}" for i in range(max((b.shape[1] for b in known.values()), default=0))])
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                chunk = _Chunk(row.to_pylist()[0], parts)
                dims = row.column("dims")[0].as_py()
                code, error = np.full(chunk.n, "", dtype=f"<U{2 * parts}"), np.zeros(chunk.n, np.int64)
                for part in range(parts):
                    entry, distance = chunk.codes(part, known[dims][part])
                    code, error = np.char.add(code, hexed[entry]), error + distance
                columns = [row.column("id").flatten(), row.column("label").flatten(), pa.array(code.tolist(), pa.string()), pa.array(error), pa.array([digests[dims]] * chunk.n, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error", "codebooks_sha256"])

    return materialize(chunks.mapInArrow(coded, schema), "coded")


def compress(
    df: DataFrame, vector: str = "embedding", id: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR
) -> DataFrame:
    """One row per vector that takes part: id, label, code, error, label_error, codebooks_sha256; at most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    rows = df.filter(usable(vector)).select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    with scratch(df.sparkSession) as keep:
        chunks = _chunks(rows, parts, factor)
        books = _first_books(rows, parts, entries, factor)
        for _ in range(rounds):
            books = _improved(chunks, books, parts)
        coded = _coded(chunks, books, parts, rows.schema["id"].dataType, rows.schema["label"].dataType)
        # Small for few labels, so that the planner ships it by its measured size; else a join in which adaptive execution splits a hot label.
        per_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
        return keep(coded.join(per_label.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of"))).drop("of"), "codes")
