"""Vector code compression: every part of a vector becomes the number of the
nearest entry of its codebook, found through memoised grid cells.

Components become integers, ``floor(SCALE * x)``, so that all distances,
sums and ties are exact. Vectors are cut into ``PARTS`` equal parts, each with a
codebook of its own that starts as that part of the vectors with the smallest
ids. A round assigns every part to its nearest entry and moves each entry
to the floored mean of its parts; unused entries stay. After ``ROUNDS`` rounds
the parts are assigned once more.

Nearest entries (``GridMemo``): a part falls in a cell of a coarse grid. For a
new cell the least and the greatest distance from each entry to the cell's box
are worked out, and the entries are remembered whose least distance is not above
the smallest greatest distance: any other entry is farther than that one from
every point of the box. Only the remembered entries are evaluated exactly, for
this part and for every later one in the cell. The memo has a bound in bytes and
starts anew when it is reached; that costs time and changes nothing.

A round is one pass over the stored integers: tasks give the count and sums of
each entry they used (at most parts x entries rows a task), Spark adds them up,
and the driver gets one row per entry, a size set by the codebooks and not by
the vectors. A hot vector or label costs nothing extra.

Vectors that are null, empty or hold a null, NaN or infinite component are dropped,
and so are those of another length than the kept vector with the smallest id, whose
length must be a multiple of ``PARTS``. Components whose integer is beyond
``LARGEST`` in magnitude end the job with an error, as sums of squares would no
longer be exact. Repeated ids keep their rows; the codebook takes them in the
order of their components, null ids last. Fewer vectors than entries give
smaller codebooks, an empty table no rows. Null labels are equal labels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import map_arrow, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CELL = 32
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
LARGEST = 1 << 27
MEMO_BYTES = 16 * 1024 * 1024
_BLOCK = 512             # parts worked out at once


class GridMemo:
    """The nearest entry of one codebook, ties to the lower number."""

    def __init__(self, book: np.ndarray, cell: int = CELL, memo_bytes: int = MEMO_BYTES):
        self.book, self.cell, self.memo_bytes = book, cell, memo_bytes
        self.known: dict[bytes, bytes] = {}
        self.evaluated = self.bounded = 0
        self.largest = int(np.abs(book).max(initial=0))

    def _kind(self, most: int) -> type:
        """Half the width where sums of squares up to ``most`` apart fit."""
        return np.int32 if self.book.shape[1] * (most + self.largest) ** 2 < 1 << 31 else np.int64

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell a row that marks the entries not dominated there: by
        least and greatest squared distances, added up along the components."""
        edge = int(np.abs(cells).max(initial=0) + 1) * self.cell
        kind = self._kind(edge)
        least = np.zeros((len(cells), len(self.book)), kind)
        most = np.zeros_like(least)
        for k in range(cells.shape[1]):
            levels, at = np.unique(cells[:, k], return_inverse=True)
            low = levels[:, None] * self.cell
            under, over = low - self.book[:, k], self.book[:, k] - (low + self.cell - 1)
            near = np.maximum(np.maximum(under, over), 0)
            far = np.maximum(np.abs(under), np.abs(over))
            least += (near * near).astype(kind)[at]
            most += (far * far).astype(kind)[at]
        self.bounded += len(cells)
        return least <= most.min(axis=1, keepdims=True)

    def _marks(self, cells: np.ndarray) -> np.ndarray:
        """``_candidates`` of every cell, remembered."""
        width = cells.shape[1] * cells.itemsize
        if len(self.known) * (width + len(self.book) // 8 + 200) > self.memo_bytes:
            self.known.clear()
        keys = np.ascontiguousarray(cells).view(f"V{width}").ravel().tolist()
        new: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            if key not in self.known:
                new.setdefault(key, i)
        if new:
            packed = np.packbits(self._candidates(cells[list(new.values())]), axis=1)
            self.known.update(zip(new, map(bytes, packed)))
        bits = np.frombuffer(b"".join([self.known[key] for key in keys]), np.uint8).reshape(len(keys), -1)
        return np.unpackbits(bits, axis=1, count=len(self.book)).view(bool)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest entries and the squared distances to them."""
        index = np.empty(len(parts), np.int64)
        distance = np.empty(len(parts), np.int64)
        for at in range(0, len(parts), _BLOCK):
            some = parts[at:at + _BLOCK]
            owner, entry = np.nonzero(self._marks(np.floor_divide(some, self.cell)))
            kind = self._kind(int(np.abs(some).max(initial=0)))
            points, book = some.astype(kind), self.book.astype(kind)
            squares = np.zeros(len(owner), kind)
            for k in range(parts.shape[1]):
                apart = points[owner, k] - book[entry, k]
                squares += apart * apart
            self.evaluated += len(owner)
            starts = np.searchsorted(owner, np.arange(len(some)))
            best = np.minimum.reduceat(squares, starts)
            first = np.flatnonzero(squares == best[owner])     # entries ascend within an owner
            hit = np.searchsorted(owner[first], np.arange(len(some)))
            index[at:at + len(some)] = entry[first[hit]]
            distance[at:at + len(some)] = best
        return index, distance


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, ints)`` of the rows with a usable vector."""
    x = F.col("embedding")
    usable = (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))

    def whole(v):
        value = F.floor(v.cast("double") * scale)
        return F.when(F.abs(v.cast("double") * scale) < LARGEST, value).otherwise(
            F.raise_error(F.lit(f"vector components beyond {LARGEST // scale} cannot be coded")))
    # a filter above the expression: it must not see what the filter drops
    ints = F.when(usable, F.transform(x, whole))
    return vectors.select("vec_id", "label", ints.alias("ints")).where(F.col("ints").isNotNull())


def _by_part(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The parts of a batch of equally long integer vectors."""
    n, parts = batch.num_rows, len(books)
    rows = batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, -1)
    for p in range(parts):
        yield p, np.ascontiguousarray(rows[:, p])


def _sums(books: np.ndarray, cell: int):
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()),
                        ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [GridMemo(b, cell) for b in books]
        n = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for b in batches:
            for p, rows in _by_part(b, books):
                index, _ = memos[p].nearest(rows)
                n[p] += np.bincount(index, minlength=len(n[p]))
                np.add.at(total[p], index, rows)
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]),
                 pa.array(list(total[part, entry]), pa.list_(pa.int64()))], schema=schema)
    return run


def train(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          cell: int = CELL) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` rounds over the
    stored table ``ints(vec_id, ints)``, whose vectors are equally long."""
    first = ints.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    size = len(first[0]["ints"]) if first else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    rows = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, size // parts)
    books = np.ascontiguousarray(rows.transpose(1, 0, 2))
    if not books.size:
        return books
    for _ in range(rounds):
        # part sums of at most parts x entries rows a task; one row per entry comes back
        sums = map_arrow(ints.select("ints"), _sums(books, cell),
                         "part int, entry int, n long, sums array<long>")
        added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(
            F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(books.shape[2])))
        for r in added.collect():
            books[r["part"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(books.shape[2])]
    return books


def _coded(books: np.ndarray, cell: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [GridMemo(b, cell) for b in books]
        digits = max(2, len(f"{max(books.shape[1] - 1, 0):x}"))
        for b in batches:
            codes, error = [], np.zeros(b.num_rows, np.int64)
            for p, rows in _by_part(b, books):
                index, distance = memos[p].nearest(rows)
                codes.append(index)
                error += distance
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in zip(*(c.tolist() for c in codes))]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(text, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])
    return run


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def usable_table(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The integer vectors as a stored table, all of one length."""
    found = stored(integers(vectors, scale), "vector-integers")
    first = found.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.size("ints").alias("n")).first()
    return found.where(F.size("ints") == (first["n"] if first else 0))


def encode(ints: DataFrame, books: np.ndarray, cell: int = CELL) -> DataFrame:
    """``(vec_id, label, code, error)`` of every row of ``ints``."""
    kinds = dict(ints.dtypes)
    return map_arrow(ints, _coded(books, cell),
                     f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE, cell: int = CELL) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every usable
    row of ``vectors(vec_id, embedding, label)``."""
    ints = usable_table(vectors, scale)
    books = train(ints, parts, entries, rounds, cell)
    coded = stored(encode(ints, books, cell), "vector-codes")
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    # labels may be as many as rows: they are broadcast by their measured size only
    size = totals.agg(F.sum(F.coalesce(F.octet_length(F.col("label").cast("string")), F.lit(0)) + 64)).first()[0]
    totals = totals.select(F.struct("label").alias("_key"), "label_error")
    totals = F.broadcast(totals) if (size or 0) <= MAX_BROADCAST_BYTES else totals.hint("merge")
    keyed = coded.select("vec_id", "code", "error", F.struct("label").alias("_key"))
    return keyed.join(totals, "_key").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
