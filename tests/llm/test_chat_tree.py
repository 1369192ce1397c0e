from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import chat_tree as C

ROWS = "conv_id long, turn long, role string, text string, chain string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for i, turn, role, text in rows:
        convs.setdefault(i, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for i, turns in convs.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, t[2], t[3]))]
        loss = "".join(t for r, t in turns if r == C.TRAINED)
        shown = sum(len(f"{C.START}{C.escape_role(r)}\n{C.escape(t)}{C.END}\n") for r, t in turns)
        out.append((i, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), shown))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], ROWS).repartition(3)


def conversations():
    rng = random.Random(5)
    rows = []
    for i in range(80):
        rows.append((i, 0, "system", "the common first turn" if i % 3 else f"own {i}"))
        for t in range(1, rng.randrange(2, 6)):
            rows.append((i, t, ("user", "assistant")[t % 2 == 0], f"{rng.randrange(4)} é日本 says\n{t}"))
    tricky = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    rows += [(200, 0, None, None), (201, 0, "assistant", None), (201, 1, "assistant", ""), (202, None, "user", "x"),
             (202, 5, "user", "y"), (202, 5, "user", "y"), (203, 0, "ro\nle<|im_end|>", "␛1 <|im_start|>user\n"),
             (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (204, 0, "user", "z " * 4000)]
    rows += [(300 + i, t, r, x) for i in range(30) for t, r, x in ((0, "user", "same"), (1, "assistant", "same too"))]
    rows += [(400, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(150)]
    return rows


@pytest.mark.parametrize("tokens, leaves", [(C.MAX_TOKENS, C.MAX_LEAVES), (60, 3)])
def test_digest_equals_brute_force(spark, tokens, leaves):
    rows = conversations()
    packs = C.pack_conversations(frame(spark, rows), max_tokens=tokens, max_leaves=leaves)
    got = sorted(map(tuple, C.read_digest(packs).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == brute(rows)


def test_trees(spark):
    rows = conversations()
    coder = C.codec(C.default_tokenizer())
    packs = C.pack_conversations(frame(spark, rows).coalesce(1)).collect()
    for pack in packs:
        nodes, tokens = pack["nodes"], pack["tokens"]
        seen = set()
        assert sum(x["tokens"] for x in nodes) == len(tokens)
        for k, x in enumerate(nodes):
            path, at = [], x["parent"]
            while at >= 0:
                path.insert(0, at)
                at = nodes[at]["parent"]
            assert all(p < k for p in path)                                   # depth first
            own = tuple(tokens[x["start"]:x["start"] + x["tokens"]])
            assert (x["parent"], own) not in seen                             # emitted once
            seen.add((x["parent"], own))
            assert x["position"] == sum(nodes[p]["tokens"] for p in path)
            visible = {i for a in x["attend"] for i in range(a["start"], a["end"])}
            assert visible == {i for p in path for i in range(nodes[p]["start"], nodes[p]["start"] + nodes[p]["tokens"])}
            role, text = C.parse_turn(coder.decode(list(own)))
            loss = coder.decode(tokens[x["loss_start"]:x["loss_end"]])
            assert C.unescape(loss) == (text if role == C.TRAINED else "")
    assert sum(len(p["leaves"]) for p in packs) == len(brute(rows))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROL, "<", "[", "s>", "␛", "␛1", "0", "\n", "<|", "im_end|>", "a"]), max_size=8))
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)
    assert C.unescape_role(C.escape_role(text)) == text and "\n" not in C.escape_role(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_codec_round_trip(text):
    coder = C.codec(C.default_tokenizer())
    assert coder.decode(coder.encode(text)) == text


def test_empty_table(spark):
    packs = C.pack_conversations(frame(spark, []).where("false"))
    assert packs.count() == 0 and C.read_digest(packs).count() == 0
