from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
DIRECT = Tokenizer.from_file(PATH)


def direct(text) -> list[int]:
    return DIRECT.encode(text or "", add_special_tokens=False).ids


def encoded(coder, *texts) -> list[list[int]]:
    return [np.frombuffer(x, coder.kind).tolist() for x in map(coder.encode, [t.encode() for t in texts])]


ODD = ["It's don't WE'LL x'd 'tis", "ÀÉß ÿ × ÷ ªº 12³ ½", "İstanbul ΑΣ ΟΔΟΣ", "é äb", "a b c\x85d",
       "x\x1cy\x1fz", "<|endoftext|>mid<|startoftext|>", "<| endoftext|>", "日本語 テスト", "😀😀 ok", "a'b''s!'s", "​﻿",
       "  \n\t ", "###$$$ %%%.", "ǅ ﬁ ﬀ", "\x00\x01 a\x7fb", "ſ K Å", "¡hola! «oui» – …"]


@pytest.mark.parametrize("text", ODD)
def test_encoder_on_odd_texts(text):
    assert encoded(T.encoder(PATH), text) == [direct(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_encoder_equals_the_library(text):
    assert encoded(T.encoder(PATH), text) == [direct(text)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aΣσÉe\u0301\u0338=<|endoftext|>' .\x85\u00a01ﬁİ한ᄒ\n", max_size=14), max_size=6))
def test_chunks_share_a_library_call(texts):
    """New chunks go through the library together; none reaches into its neighbour."""
    texts = [*texts, "\n".join(texts)]
    assert encoded(T.TextEncoder(PATH), *texts) == [direct(t) for t in texts]


def test_cache_forgets_what_is_not_used(monkeypatch):
    monkeypatch.setattr(T, "CACHE_BYTES", 3 * T.ENTRY_BYTES)
    monkeypatch.setattr(T, "STRETCH_BYTES", 5)
    coder = T.TextEncoder(PATH)
    texts = ["hot a b c d e f", "hot g-h i", "hot", "hot j k l m n o", "p hot", "a b"] * 5
    assert encoded(coder, *texts) == [direct(t) for t in texts]
    texts = ["é日 a", "hot 日", "hot b c d é日 e f g"] * 5
    assert encoded(coder, *texts) == [direct(t) for t in texts]
    for known, key in ((coder.pieces, "hot"), (coder.chunks, b"hot")):
        assert key in known or key in known.old
        assert 0 < len(known) + len(known.old) <= 20


def test_white_space_is_a_property_of_the_tokenizer(spark, docs_of):
    """A byte-level tokenizer keeps white space: whole texts, whatever the file's name."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    assert T.parts_at_white_space(DIRECT) and not T.parts_at_white_space(library)
    texts = ["  a  b\n\nc\t", "", "x", " \n ", *ODD]
    assert encoded(T.TextEncoder(path), *texts) == [library.encode(t).ids for t in texts]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    got = T.read_digest(T.write_tokens(docs_of(rows), tokenizer=path, end_id=None)).collect()
    assert [r["n_tokens"] for r in sorted(got, key=lambda r: r["doc_id"])] == [len(library.encode(t).ids) for t in texts]


@pytest.mark.parametrize("width", [None, 4])
@pytest.mark.parametrize("per_task", [7, T.READ_IDS])
def test_files_round_trip(spark, docs_of, prose, width, per_task):
    rows = [(i * 7 % 50, prose(i, 5 + i), "s") for i in range(50)]
    rows += [(100 + k, t, "s") for k, t in enumerate(ODD)]
    rows += [(60, None, None), (61, "", "s"), (62, "same", "s"), (62, "same", "s"), (62, "other", "s"),
             (None, "nobody", "s"), (-5, prose(3, 9000), "s")]
    manifest = T.write_tokens(docs_of(rows, "start n_tokens shard"), width=width)
    got = sorted(T.read_digest(manifest, per_task).collect(), key=lambda r: r["start"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert len(got) == len(rows)
    for r, (i, text, _) in zip(got, order):
        ids = direct(text) + [T.END_ID]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_without_end_id_empty_documents_stay(spark, docs_of):
    rows = [(1, "", "s"), (2, "a b", "s"), (3, None, "s"), (4, "c", "s"), (5, "", "s")]
    for per_task in (1, 100):
        got = T.read_digest(T.write_tokens(docs_of(rows), end_id=None), per_task).collect()
        assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [
            (i, len(direct(t))) for i, t, _ in rows]


def test_files_are_flat(spark, docs_of, prose):
    part = T.write_tokens(docs_of([(1, "a b c", "s"), (2, "d", "s")]).coalesce(1)).collect()
    ids = [x for p in sorted(part, key=lambda p: p["shard"])
           for x in T.read_ids(p["bin"], p["width"], 0, p["n_tokens"]).tolist()]
    assert ids == direct("a b c") + [1] + direct("d") + [1]


def test_empty_table(spark, docs_of):
    empty = docs_of([]).where("false")
    assert T.read_digest(T.write_tokens(empty)).count() == 0


def test_given_order(spark, docs_of):
    rows = [(i, f"word{i}", "s") for i in range(30)]
    manifest = T.write_tokens(docs_of(rows), order=[-F.col("doc_id")])
    got = sorted(T.read_digest(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == list(range(29, -1, -1))
