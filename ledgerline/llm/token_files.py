"""Token ids as flat unsigned integer files with 64-bit document offsets.

``write_tokens`` orders the documents (range partitions, sorted inside),
encodes each whole text, appends the end id and writes one pair of files per
partition:

* ``*.bin``  the ids of its documents, back to back, little-endian unsigned
  16-bit integers when the vocabulary fits and 32-bit otherwise;
* ``*.idx``  ``MAGIC``, then as little-endian 64-bit integers: bytes per id,
  number of documents n, the n + 1 offsets of the documents in ids, the n
  document ids, and then n bytes that are 0 where the document id was null.

A task names its files after its partition and attempt and reports them in
one manifest row, which Spark commits with the task; files of failed or
repeated attempts are in no manifest and so are never read. The manifest with
``base``, the ids in all partitions before, from prefix sums over its few
rows, makes the parts one id stream: document d of a part starts at
``base + offsets[d]``. Readers memory-map the files where the folder is
mounted and otherwise fetch only their byte ranges.

How a text is encoded depends on what the tokenizer's own normalizer and
pre-tokenizer say, never on its name. Where ASCII white space is dropped and
nothing reaches across it, a text's ids are those of its white-space separated
chunks in order: they are looked up, and those not known yet go through the
tokenizers library in one call. Where the text is also lowered and parted into
letters, digits and symbols, texts of plain Latin characters are parted here by
one regular expression, and their pieces, of which there are fewer, go to the
model alone. Any other tokenizer encodes whole texts. What is known is kept in
two generations of about ``CACHE_BYTES`` each: when the younger is full the older
is forgotten and the younger takes its place, so what is in use stays. Long texts
are taken in stretches of ``STRETCH_BYTES``, parted at white space.

Nulls and empty texts give a document of only the end id. A null document id
sorts first and stays null. Repeated document ids keep their rows, ordered by
text. An empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import (
    local_path, map_arrow, open_fs, raw_texts, shared_folder, sized_partitions, stored,
)

MAGIC = b"LLTOKEN1"
END_ID = 1
CACHE_BYTES = 24 * 1024 * 1024      # of a generation
STRETCH_BYTES = 1024 * 1024       # of a text encoded at once
TEXTS_AT_ONCE = 500
READ_IDS = 8 * 1024 * 1024       # ids per read task
MANIFEST = "shard long, bin string, idx string, width long, n_docs long, n_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


ENTRY_BYTES = 250                 # of a cache entry, about
KEPT_LENGTH = 64                  # of a chunk or piece
_LOCAL_NORMALIZERS = {"NFC", "NFD", "Lowercase"}
_SPACE_SPLITTERS = {"WhitespaceSplit", "Whitespace", "BertPreTokenizer"}
_PROBE = "".join(f"a{w}1{w}.{w}'s{w}{w}A\u3042{w}-{w * 3}" for w in " \t\n\v\f\r")


# fixed values: the normalizer and the splitting of tokenizers whose plain Latin
# chunks are parted here
_LATIN_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                      {"type": "Lowercase"}]
_LATIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# plain Latin: the canonical form is the text itself, and these are its letters once lowered
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\\t-\\r ]+")


_SPACE = re.compile(b"[\\t-\\r ]")


def _byte_level() -> list[str]:
    """The printable character that byte-level BPE writes for each byte:
    itself where printable, else the next free code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def _steps(component, key: str) -> list[dict]:
    if component is None:
        return []
    state = json.loads(component.__getstate__())
    return state[key] if state["type"] == "Sequence" else [state]


def parts_at_white_space(tokenizer) -> bool:
    """Whether a text's ids are those of its chunks between ASCII white space."""
    import regex
    if tokenizer.truncation or tokenizer.padding or tokenizer.post_processor is not None:
        return False
    if any(set(t.content) & set(" \t\n\v\f\r") or t.lstrip or t.rstrip or t.single_word or t.normalized
           for t in tokenizer.get_added_tokens_decoder().values()):
        return False
    for step in _steps(tokenizer.normalizer, "normalizers"):
        blanks = step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " "
        if step["type"] not in _LOCAL_NORMALIZERS and not blanks:
            return False
    first = (_steps(tokenizer.pre_tokenizer, "pretokenizers") or [{"type": None}])[0]
    if first["type"] in _SPACE_SPLITTERS:
        return True
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return False
    pattern = first["pattern"].get("Regex")
    return bool(pattern) and not regex.search("[ \t\n\v\f\r]", "".join(regex.findall(pattern, _PROBE)))


def parts_latin(tokenizer) -> bool:
    """Whether plain Latin chunks may be parted here and given to the model."""
    steps = _steps(tokenizer.pre_tokenizer, "pretokenizers")
    return (_steps(tokenizer.normalizer, "normalizers") == _LATIN_NORMALIZERS and len(steps) == 2
            and steps[0]["pattern"] == {"Regex": _LATIN_SPLIT}
            and steps[1] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False})


class Known(dict):
    """The ids of chunks or pieces, the younger generation. Long ones are few
    and are not kept."""

    old: dict = {}

    def turn(self) -> None:
        """Between texts: a full generation becomes the older one."""
        if len(self) > CACHE_BYTES // ENTRY_BYTES:
            self.old = dict(self)
            self.clear()


class Pieces(Known):
    """The ids of lowered pieces, worked out by the model when they are asked for."""

    def __init__(self, model, vocabulary: int, width: int):
        self.model, self.shown = model, _byte_level()
        self.one = [i.to_bytes(width, "little") for i in range(vocabulary)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else "".join([self.shown[b] for b in piece.encode()])
            one = self.one
            ids = b"".join([one[t.id] for t in self.model.tokenize(shown)])
        if len(piece) <= KEPT_LENGTH:
            self[piece] = ids
        return ids


class TextEncoder:
    """Ids of whole texts, as little-endian bytes."""

    def __init__(self, path: str, width: int | None = None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = width or (2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4)
        self.kind = np.dtype(f"<u{self.width}")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_chunk = parts_at_white_space(self.tokenizer)
        self.by_piece = self.by_chunk and parts_latin(self.tokenizer)
        self.chunks = Known()
        self.pieces = Pieces(self.tokenizer.model, self.tokenizer.get_vocab_size(), self.width)

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _whole(self, raw: bytes) -> bytes:
        return self._ids(self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids)

    def _learnt(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """The ids of new chunks by one call: each id goes to the chunk in
        which its characters begin."""
        texts = [c.decode() for c in chunks]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        data = self._ids(found.ids)
        begins = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        ends = (np.searchsorted(begins, starts[1:]) * self.width).tolist()
        return zip(chunks, map(data.__getitem__, map(slice, [0, *ends], ends)))

    def _by_chunks(self, raw: bytes) -> bytes:
        words = raw.split()                         # at ASCII white space
        known, learn = {}, []
        for chunk in set(words):
            ids = self.chunks.get(chunk) or self.chunks.old.get(chunk)
            if ids is None and any(x in chunk for x in self.special):
                ids = self._whole(chunk)
            if ids is None:
                learn.append(chunk)
            else:
                known[chunk] = ids
        known.update(self._learnt(learn) if learn else ())
        self.chunks.update((c, ids) for c, ids in known.items() if len(c) <= KEPT_LENGTH)
        self.chunks.turn()
        return b"".join(map(known.__getitem__, words))

    def _stretch(self, raw: bytes) -> bytes:
        if self.by_piece and not any(x in raw for x in self.special):
            text = raw.decode()
            if _PLAIN.fullmatch(text):
                ids = b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
                self.pieces.turn()
                return ids
        return self._by_chunks(raw)

    def encode(self, raw: bytes) -> bytes:
        """The ids of a whole text."""
        if not self.by_chunk:
            return self._whole(raw)
        if len(raw) <= STRETCH_BYTES:
            return self._stretch(raw)
        out, at = [], 0
        while at < len(raw):
            cut = _SPACE.search(raw, at + STRETCH_BYTES)
            end = cut.start() if cut else len(raw)
            out.append(self._stretch(raw[at:end]))
            at = end
        return b"".join(out)


_ENCODERS: dict[tuple[str, int | None], TextEncoder] = {}


def encoder(path: str, width: int | None = None) -> TextEncoder:
    """One encoder per worker process, kept across tasks; its size is bounded
    by the vocabulary and ``CACHE_BYTES``."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, width) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, width] = TextEncoder(path, width)
    return _ENCODERS[path, width]


def _write_shard(folder: str, tokenizer: str, width: int | None, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        task = TaskContext.get()
        shard, out = task.partitionId(), None
        name = f"{folder}/part-{shard:06d}-{task.taskAttemptId()}"
        offsets, ids = [0], []
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                if out is None:
                    coder = encoder(tokenizer, width)
                    end = b"" if end_id is None else np.array([end_id], coder.kind).tobytes()
                    fs, path = open_fs(f"{name}.bin")
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    out = fs.open_output_stream(path)
                ids.extend(b.column("doc_id").to_pylist())
                for at in range(0, b.num_rows, TEXTS_AT_ONCE):
                    for raw in raw_texts(b.column("text").slice(at, TEXTS_AT_ONCE)):
                        data = coder.encode(raw)
                        out.write(data + end)
                        offsets.append(offsets[-1] + len(data) // coder.width + len(end) // coder.width)
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        fs, path = open_fs(f"{name}.idx")
        with fs.open_output_stream(path) as index:
            index.write(MAGIC)
            index.write(np.array([coder.width, len(ids)], "<i8").tobytes())
            index.write(np.array(offsets, "<i8").tobytes())
            index.write(np.array([i or 0 for i in ids], "<i8").tobytes())
            index.write(bytes(i is not None for i in ids))
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "bin": [f"{name}.bin"], "idx": [f"{name}.idx"], "width": [coder.width],
            "n_docs": [len(ids)], "n_tokens": [offsets[-1]]})
    return run


def write_tokens(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID,
                 order: list[Column] | None = None, folder: str | None = None,
                 width: int | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending ``order`` (default: document
    id) into token files; returns the manifest with ``base``, one row per
    part, read back from where it was written."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    order = order or [F.col("doc_id")]
    keys = [f"_order{k}" for k in range(len(order))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *[c.alias(k) for c, k in zip(order, keys)])
    n = sized_partitions(docs, "text")
    rows = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "doc_id", "text")
    written = map_arrow(rows.select("doc_id", "text"),
                        _write_shard(folder, tokenizer or default_tokenizer(), width, end_id), MANIFEST)
    manifest = stored(written, "token-manifest")
    # one row per part: the prefix sums run over the parts, not over the documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_index(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Offsets, document ids, their validity and the bytes per id of one part."""
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as f:
        data = f.read()
    if data[:8] != MAGIC:
        raise ValueError(f"{uri} is not a token index")
    width, n = np.frombuffer(data, "<i8", 2, 8)
    offsets = np.frombuffer(data, "<i8", int(n) + 1, 24)
    ids = np.frombuffer(data, "<i8", int(n), 24 + offsets.nbytes)
    valid = np.frombuffer(data, np.uint8, int(n), 24 + offsets.nbytes + ids.nbytes)
    return offsets, ids, valid.astype(bool), int(width)


def read_ids(uri: str, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``[start, stop)`` of one part: a memory map where the folder is
    mounted, else one range read."""
    if stop <= start:
        return np.zeros(0, f"<u{width}")
    local = local_path(uri)
    if local:
        return np.memmap(local, f"<u{width}", "r", start * width, (stop - start,))
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_at((stop - start) * width, start * width), f"<u{width}")


def _read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in b.to_pylist():
            offsets, ids, valid, width = read_index(part["idx"])
            # the documents that start in this piece of the part
            lo = int(np.searchsorted(offsets[:-1], part["first"], "left"))
            hi = int(np.searchsorted(offsets[:-1], part["last"], "left"))
            for a in range(lo, hi, 20_000):
                z = min(hi, a + 20_000)
                crc = []
                for d in range(a, z):
                    block, value = READ_IDS, 0
                    for at in range(int(offsets[d]), int(offsets[d + 1]), block):
                        data = read_ids(part["bin"], width, at, min(at + block, int(offsets[d + 1])))
                        value = zlib.crc32(data.astype("<u4").tobytes(), value)
                    crc.append(value)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[a:z], mask=~valid[a:z]), pa.array(part["base"] + offsets[a:z]),
                    pa.array(np.diff(offsets[a:z + 1])), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digest(manifest: DataFrame, ids_per_task: int = READ_IDS) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, read back from
    the files: each part is read in pieces of about ``ids_per_task`` ids; a
    piece owns the documents that start inside it."""
    pieces = manifest.select(
        "bin", "idx", "base", "n_tokens",
        F.explode(F.sequence(F.lit(0).cast("long"),
                             F.greatest(F.col("n_tokens") - 1, F.lit(0)).cast("long"),
                             F.lit(ids_per_task).cast("long"))).alias("first"))
    pieces = pieces.select(
        "bin", "idx", "base", "first",
        # without an end id empty documents start at the very end of a part
        F.when(F.col("first") + ids_per_task >= F.col("n_tokens"), F.col("n_tokens") + 1)
        .otherwise(F.col("first") + ids_per_task).alias("last"))
    # dealt round robin so that every core reads; a handful of rows per part
    spread = pieces.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 2)
    return map_arrow(spread, _read_parts, "doc_id long, start long, n_tokens long, ids_crc32 long")
