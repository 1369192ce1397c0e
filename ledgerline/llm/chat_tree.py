"""Chat formatting as prefix trees.

Conversations that share their first turns share them in the output: they are
merged into a tree whose nodes are turns, and each node's tokens are emitted
once, depth first. Every node carries the position of its first token on its
own path (position ids run on from the parent, whatever lies between in the
sequence) and the token intervals of its ancestors, which with the node's own
earlier tokens are all it may attend to.

Template: ``<|im_start|>role\\ncontent<|im_end|>\\n``. Control strings inside
roles and contents are escaped reversibly: an escape character is doubled up
as ``ESC 0`` and ``ESC 1`` is put behind the first character of every place
where a control string begins, so that none is left. Each part of a turn is
encoded by itself with a byte-level tokenizer, so the content's tokens are an
exact interval: the loss mask of assistant turns.

Conversations are range partitioned by a chain of turn hashes and sorted, which
brings equal beginnings together; a task builds the trees as it reads. Trees
are cut into packs of at most ``MAX_TOKENS`` tokens and ``MAX_LEAVES``
conversations, between conversations only: a beginning shared by more than a
pack holds is emitted once per pack, so no task needs a whole hot tree, and a
conversation longer than a pack has one of its own. Ranges are taken over the
chain and the conversation id, so also very many equal conversations are
spread.

Nulls: a null role or text is empty. Rows of a conversation are ordered by
turn, then role and text; repeated turns are kept. Rows without a conversation
id form one conversation without id. An empty table gives no packs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import map_arrow, sized_partitions

START, END = "<|im_start|>", "<|im_end|>"
ESCAPE = "␛"
# fixed values: strings that mean something to chat templates
CONTROL = (START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]",
           "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"
MAX_TOKENS = 32_768
MAX_LEAVES = 1024
MAX_MARKS = 10_000

_CONTROL_AT = re.compile("(?=(?:" + "|".join(map(re.escape, CONTROL)) + "))(.)", re.S)

NODE = ("struct<parent:int,start:int,tokens:int,position:int,loss_start:int,loss_end:int,"
        "attend:array<struct<start:int,end:int>>>")
PACK = f"tokens array<int>, nodes array<{NODE}>, leaves array<struct<conv_id:long,node:int>>"


def escape(text: str) -> str:
    return _CONTROL_AT.sub(lambda m: m[1] + ESCAPE + "1", text.replace(ESCAPE, ESCAPE + "0"))


def unescape(text: str) -> str:
    return text.replace(ESCAPE + "1", "").replace(ESCAPE + "0", ESCAPE)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role).replace("\n", ESCAPE + "2")


def unescape_role(role: str) -> str:
    return unescape(role.replace(ESCAPE + "2", "\n"))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Text to ids and back, control strings in texts as ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.marks: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids if text else []

    def mark(self, text: str) -> list[int]:
        """The ids of a turn's head or tail, which are few and repeat."""
        found = self.marks.get(text)
        if found is None:
            if len(self.marks) >= MAX_MARKS:
                self.marks.clear()
            found = self.marks[text] = self.encode(text)
        return found

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False) if ids else ""


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


class Pack:
    """One sequence under construction."""

    def __init__(self, coder: Codec):
        self.coder = coder
        self.tokens: list[int] = []
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.path: list[tuple[tuple[str, str], int]] = []     # turns of the latest path and their nodes

    def shared(self, turns: list[tuple[str, str]]) -> int:
        n = 0
        while n < min(len(turns), len(self.path)) and self.path[n][0] == turns[n]:
            n += 1
        return n

    def add(self, conv_id: int | None, turns: list[tuple[str, str]], pieces: list[tuple]) -> None:
        """Append what the latest path does not share with ``turns``."""
        keep = self.shared(turns)
        del self.path[keep:]
        for turn, (head, content, tail) in zip(turns[keep:], pieces[keep:]):
            parent = self.path[-1][1] if self.path else -1
            start = len(self.tokens)
            above = self.nodes[parent] if parent >= 0 else None
            attend = [] if above is None else [
                *above["attend"], {"start": above["start"], "end": above["start"] + above["tokens"]}]
            if len(attend) > 1 and attend[-2]["end"] == attend[-1]["start"]:      # neighbours are one interval
                attend[-2:] = [{"start": attend[-2]["start"], "end": attend[-1]["end"]}]
            self.tokens += head + content + tail
            trained = turn[0] == TRAINED
            self.nodes.append({
                "parent": parent, "start": start, "tokens": len(self.tokens) - start,
                "position": 0 if above is None else above["position"] + above["tokens"],
                "loss_start": start + len(head) if trained else start,
                "loss_end": start + len(head) + len(content) if trained else start, "attend": attend})
            self.path.append((turn, len(self.nodes) - 1))
        self.leaves.append({"conv_id": conv_id, "node": self.path[-1][1] if self.path else -1})

    def row(self) -> dict:
        return {"tokens": self.tokens, "nodes": self.nodes, "leaves": self.leaves}


_INTERVAL = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_PACK = pa.schema([
    ("tokens", pa.list_(pa.int32())),
    ("nodes", pa.list_(pa.struct([
        ("parent", pa.int32()), ("start", pa.int32()), ("tokens", pa.int32()), ("position", pa.int32()),
        ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("attend", pa.list_(_INTERVAL))]))),
    ("leaves", pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])))])


def _packer(tokenizer: str, max_tokens: int, max_leaves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        pack, previous, pieces = Pack(coder), [], []
        for b in batches:
            done = []
            ids = b.column("conv_id").to_pylist()
            for conv_id, rows in zip(ids, b.column("turns").to_pylist()):
                turns = [(r["role"], r["text"]) for r in rows]
                same = 0
                while same < min(len(turns), len(previous)) and previous[same] == turns[same]:
                    same += 1
                pieces = pieces[:same] + [
                    (coder.mark(f"{START}{escape_role(role)}\n"), coder.encode(escape(text)),
                     coder.mark(f"{END}\n")) for role, text in turns[same:]]
                previous = turns
                fresh = sum(len(x) for p in pieces[pack.shared(turns):] for x in p)
                if pack.leaves and (len(pack.leaves) >= max_leaves
                                    or len(pack.tokens) + fresh > max_tokens):
                    done.append(pack.row())
                    pack = Pack(coder)
                pack.add(conv_id, turns, pieces)
            if done:
                yield pa.RecordBatch.from_pylist(done, _PACK)
        if pack.leaves:
            yield pa.RecordBatch.from_pylist([pack.row()], _PACK)
    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the chain: eight bytes per turn, each from the turn and all before."""
    for b in batches:
        chains = []
        for rows in b.column("turns").to_pylist():
            state, chain = hashlib.sha256(), []
            for r in rows:
                role, text = r["role"].encode(), r["text"].encode()
                state.update(b"%d,%d:" % (len(role), len(text)) + role + text)
                chain.append(state.digest()[:8])
            chains.append(b"".join(chain))
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turns"), pa.array(chains, pa.binary())],
                                         names=["conv_id", "turns", "chain"])


def conversations_of(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` from one row per turn."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))
    return found.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def pack_conversations(rows: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS,
                       max_leaves: int = MAX_LEAVES) -> DataFrame:
    """Packs of the conversations in ``rows(conv_id, turn, role, text)``: the
    token ids, the nodes with position and attention intervals, and the
    conversations with their last node."""
    n = sized_partitions(rows, "text", 32 * 1024 * 1024)
    conversations = conversations_of(rows)
    kind = "array<struct<role:string,text:string>>"
    chained = map_arrow(conversations.select("conv_id", F.col("turns").cast(kind).alias("turns")), _chained,
                        f"conv_id long, turns {kind}, chain binary")
    # a range key needs no more than the first turns; the id parts equal conversations
    spread = (chained.withColumn("_range", F.substring("chain", 1, 64))
              .repartitionByRange(n, "_range", "conv_id").sortWithinPartitions("chain", "conv_id"))
    return map_arrow(spread.select("conv_id", "turns"),
                     _packer(tokenizer or default_tokenizer(), max_tokens, max_leaves), PACK)


def parse_turn(text: str) -> tuple[str, str]:
    """Role and content of a formatted turn, unescaped."""
    if not (text.startswith(START) and text.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, content = text[len(START):-len(END) - 1].partition("\n")
    return unescape_role(role), unescape(content)


def _reader(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for b in batches:
            for pack in b.to_pylist():
                tokens, nodes = pack["tokens"], pack["nodes"]
                shown = []
                for x in nodes:
                    cut = (x["start"], x["loss_start"], x["loss_end"], x["start"] + x["tokens"])
                    head, loss, tail = (coder.decode(tokens[a:b]) for a, b in zip(cut, cut[1:]))
                    text = head + loss + tail
                    shown.append((*parse_turn(text), unescape(loss), len(text)))
                out = []
                for leaf in pack["leaves"]:
                    path, at = [], leaf["node"]
                    while at >= 0:
                        path.append(at)
                        at = nodes[at]["parent"]
                    turns, loss, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0
                    for at in reversed(path):
                        role, content, trained, shown_size = shown[at]
                        turns.update(f"{role}\n{content}\n".encode())
                        loss.update(trained.encode())
                        chars += len(trained)
                        size += shown_size
                    out.append((leaf["conv_id"], len(path), turns.hexdigest(), chars, loss.hexdigest(), size))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(),
                                                           pa.string(), pa.int64()))],
                    names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return run


def read_digest(packs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """What each conversation is once read back from its pack's tokens."""
    return map_arrow(packs, _reader(tokenizer or default_tokenizer()),
                     "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                     "formatted_chars long")
