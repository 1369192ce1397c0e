"""Fill-in-the-middle transformation by secondary-sort assembly.

A document is cut into units (white space with the word after it; white space
at the very end is a unit of its own). Two hashed cuts part it into prefix,
middle and suffix, and a hashed draw chooses its form: ``plain`` (the text
itself), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle),
each part behind its marker. Texts that hold a marker stay plain, so that the
output can always be taken apart again.

1. ``cut`` emits each document as pieces of at most ``CHUNK_UNITS`` units, keyed
   by the document and the position that the piece takes in the output.
2. ``assemble`` deals the pieces to partitions by document and sorts each
   partition by (document, position), which is what an RDD's
   ``repartitionAndSortWithinPartitions`` does, in the JVM and spilling to disk.
   Whoever reads a partition sees the outputs go by, piece after piece.
3. ``restore`` streams them into an incremental digest and takes each output
   apart at its markers, from its bytes and its form alone. What it finds is
   sorted anew, by (document, place in the text), within the same partitions:
   all of a document is there already, so no second exchange is needed.
4. ``digest`` streams the restored pieces into a second incremental digest.

A task holds one piece at a time, whatever the length of a document.

A document row is told by its id, its text, and, for equal rows, by the
partition it came from and its count there; so repeated ids and repeated rows
are documents of their own. No text is an empty text. A null document id draws
as an empty decimal number. An empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import map_arrow, raw_texts, sized_partitions

SEED = 42
FIM_PERCENT = 50          # documents that are transformed
SPM_PERCENT = 80          # of those, the ones in suffix-first order
CHUNK_UNITS = 1024
BATCH_BYTES = 4 * 1024 * 1024
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Place of each part in the text, by its marker.
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_MARKER = re.compile(b"|".join(re.escape(m) for m in _PLACE))
_HELD = max(map(len, _PLACE)) - 1

_FACTS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string")
_STREAM = f"key binary, part int, seq int, data binary, {_FACTS}"
_STREAM_ARROW = pa.schema([
    ("key", pa.binary()), ("part", pa.int32()), ("seq", pa.int32()), ("data", pa.binary()),
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output_sha256", pa.string())])
_NO_FACTS = (None,) * 6


def unit_ends(raw: bytes) -> np.ndarray:
    """Byte offsets at which the units of a text end."""
    if not raw:
        return np.zeros(0, np.int64)
    chars = np.frombuffer(raw, np.uint8)
    space = (chars == 0x20) | ((chars >= 0x09) & (chars <= 0x0D))
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(raw))


def n_chars(raw: bytes) -> int:
    """Code points of a UTF-8 text."""
    return len(raw) - int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 == 0x80))


def draw(doc_id: int | None, n: int, raw: bytes, seed: int = SEED) -> tuple[str, int, int]:
    """Form and the units after which prefix and middle end."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = [int.from_bytes(x, "big") for x in _groups(hashlib.sha256(text.encode()).digest())]
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not raw or _MARKER.search(raw) or h[2] % 100 >= FIM_PERCENT:
        return PLAIN, 0, n
    return (SPM if h[3] % 100 < SPM_PERCENT else PSM), first, second


def _groups(digest: bytes) -> list[bytes]:
    return [digest[k:k + 4] for k in range(0, 16, 4)]


def pieces(raw: bytes, form: str, ends: np.ndarray, first: int, second: int,
           units: int = CHUNK_UNITS) -> Iterator[bytes]:
    """The output in order, in pieces of at most ``units`` units."""
    at = lambda k: int(ends[k - 1]) if k else 0
    n = len(ends)
    parts = {PLAIN: [(b"", 0, n)],
             PSM: [(PREFIX, 0, first), (SUFFIX, second, n), (MIDDLE, first, second)],
             SPM: [(SUFFIX, second, n), (PREFIX, 0, first), (MIDDLE, first, second)]}[form]
    for marker, begin, end in parts:
        for k in range(begin, max(end, begin + 1), units):
            yield (marker if k == begin else b"") + raw[at(k):at(min(k + units, end))]


class _Out:
    """Rows of a stream, given out in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.size = [], 0


def _cutter(seed: int, units: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, out = TaskContext.get().partitionId(), {}, _Out(_STREAM_ARROW)
        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), raw_texts(b.column("text"))):
                row = hashlib.blake2b(b"%s:" % str(doc_id).encode() + raw, digest_size=16).digest()
                seen[row] = seen.get(row, 0) + 1
                key = hashlib.blake2b(b"%d:%d:" % (task, seen[row]) + row, digest_size=16).digest()
                ends = unit_ends(raw)
                form, first, second = draw(doc_id, len(ends), raw, seed)
                lengths = (None, None)
                if form != PLAIN:
                    p, m = (int(ends[k - 1]) if k else 0 for k in (first, second))
                    lengths = (n_chars(raw[:p]), n_chars(raw[p:m]))
                facts = (doc_id, len(ends), form, *lengths, None)
                for seq, data in enumerate(pieces(raw, form, ends, first, second, units)):
                    yield from out.add((key, 0, seq, data, *(facts if seq == 0 else _NO_FACTS)), len(data))
        yield from out.flush()
    return run


def cut(docs: DataFrame, seed: int = SEED, units: int = CHUNK_UNITS) -> DataFrame:
    """The outputs of ``docs(doc_id, text)`` in pieces: ``key`` tells the
    document, ``seq`` the piece's position in its output; the first piece
    carries the document's facts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _cutter(seed, units), _STREAM)


def assemble(docs: DataFrame, seed: int = SEED, units: int = CHUNK_UNITS) -> DataFrame:
    """The pieces of ``cut``, a document's all in one partition and in the
    order of its output."""
    n = sized_partitions(docs, "text")
    return cut(docs, seed, units).repartition(n, "key").sortWithinPartitions("key", "part", "seq")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


class _Parts:
    """Takes an output apart as it streams by: the parts and their bytes."""

    def __init__(self, form: str):
        self.plain, self.place, self.held = form == PLAIN, 0, b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if self.plain:
            yield 0, data
            return
        data, at = self.held + data, 0
        for m in _MARKER.finditer(data):
            yield self.place, data[at:m.start()]
            self.place, at = _PLACE[m.group()], m.end()
        # a marker may go on in the next piece
        stop = max(at, len(data) - _HELD)
        yield self.place, data[at:stop]
        self.held = data[stop:]

    def rest(self) -> tuple[int, bytes]:
        return self.place, self.held


def _take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, key, seq = _Out(_STREAM_ARROW), None, 0

    def ended() -> Iterator[tuple]:
        place, data = parts.rest()
        if data:
            yield key, place, seq, data, *_NO_FACTS
        yield key, -1, 0, None, *facts[:-1], sha.hexdigest()

    for k, _, _, data, *row in _rows(batches):
        if k != key:
            if key is not None:
                for x in ended():
                    yield from out.add(x, _HELD)
            key, facts, seq, sha, parts = k, row, 0, hashlib.sha256(), _Parts(row[2])
        sha.update(data)
        for place, found in parts.feed(data):
            if found:
                yield from out.add((key, place, seq, found, *_NO_FACTS), len(found))
                seq += 1
    if key is not None:
        for x in ended():
            yield from out.add(x, _HELD)
    yield from out.flush()


def restore(assembled: DataFrame) -> DataFrame:
    """The pieces of the texts, read from the outputs of ``assemble`` and
    sorted by their place in the text; before them, as part -1, the document's
    facts with the digest of its output."""
    return map_arrow(assembled, _take_apart, _STREAM).sortWithinPartitions("key", "part", "seq")


_DIGEST = f"{_FACTS}, restored_sha256 string"
_DIGEST_ARROW = pa.schema([*list(_STREAM_ARROW)[4:], pa.field("restored_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, facts = _Out(_DIGEST_ARROW), None
    for _, part, _, data, *row in _rows(batches):
        if part == -1:
            if facts:
                yield from out.add((*facts, sha.hexdigest()), 128)
            facts, sha = row, hashlib.sha256()
        else:
            sha.update(data)
    if facts:
        yield from out.add((*facts, sha.hexdigest()), 128)
    yield from out.flush()


def digest(restored: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256)`` per document."""
    return map_arrow(restored, _digests, _DIGEST)


_TEXT_ARROW = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("text", pa.string())])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, key, parts = _Out(_TEXT_ARROW), None, []
    for k, _, _, data, *row in _rows(batches):
        if k != key:
            if key is not None:
                yield from out.add((facts[0], facts[2], b"".join(parts).decode()), sum(map(len, parts)))
            key, facts, parts = k, row, []
        parts.append(data)
    if key is not None:
        yield from out.add((facts[0], facts[2], b"".join(parts).decode()), sum(map(len, parts)))
    yield from out.flush()


def transform(docs: DataFrame, seed: int = SEED, units: int = CHUNK_UNITS) -> DataFrame:
    """``(doc_id, form, text)``: the output of every document as a text."""
    return map_arrow(assemble(docs, seed, units), _whole, "doc_id long, form string, text string")
