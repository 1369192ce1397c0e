from __future__ import annotations

import random
import re

import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import common, simhash
from ledgerline.llm.common import connected_components

from .conftest import components


def plain_fingerprint(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    grams = [words[i:i + 4] for i in range(len(words) - 3)] if len(words) >= 4 else [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBÉé \n\t\x0b\x1f z", max_size=60))
def test_fingerprint_equals_plain_one(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_components_of_graphs(spark):
    rng = random.Random(3)
    graphs = [[], [(i, i + 1) for i in range(20)] + [(21, i) for i in range(22, 40)]
              + [(45, 45), (47, 42), (42, 47), (49, 47)],
              [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]]
    for links in graphs:
        df = spark.createDataFrame([(a, b) for a, b in links] + [(None, 3)], "a long, b long")
        got = {r["node"]: r["root"] for r in connected_components(df).collect()}
        want = components(60, links)
        linked = {x for a, b in links if a != b for x in (a, b)}
        assert got == {i: want[i] for i in linked}


@pytest.mark.parametrize("radius, hot", [(0, 1), (1, 1), (3, 3), (4, 1), (4, 1000)])
def test_links_equal_brute_force(spark, radius, hot):
    rng = random.Random(radius)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):                       # families of near prints and loners
        centre = rng.getrandbits(64)
        for _ in range(12):
            p = centre
            for _ in range(rng.randrange(5)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    docs = [(k, f) for k, f in enumerate(signed)] + [(1000 + k, f) for k, f in enumerate(signed[:5])]
    df = spark.createDataFrame(docs, "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.components(df, radius, hot).collect()}
    ordered = sorted(prints)
    want = components(len(ordered), [(i, j) for i in range(len(ordered)) for j in range(i)
                                     if (ordered[i] ^ ordered[j]).bit_count() <= radius])
    assert got == {k: want[k] for k in range(len(signed))} | {1000 + k: want[k] for k in range(5)}


@pytest.mark.parametrize("n", [10, 1 << 20, 1 << 34])
def test_every_cut_reaches_every_pair(n):
    """Any two prints within the radius are within the ball of some segment."""
    rng = random.Random(n)
    cut = simhash.plan_segments(n, 4)
    assert all(w + s <= 64 for s, w, _ in cut)
    for _ in range(300):
        bits = rng.sample(range(64), 4)
        assert any(sum(s <= b < s + w for b in bits) <= ball for s, w, ball in cut)


def test_documents(spark, docs_of, prose):
    base = prose(1, 400)
    near = base.replace(base.split()[200], "changed", 1)
    rows = [(5, base, "a"), (3, near, "a"), (9, base.upper(), "b"), (1, prose(2, 300), "b"), (2, None, None),
            (4, "", "c"), (6, " \n\t", "c"), (7, "one two", "c"), (8, "ONE  two", "c"), (8, "ONE  two", "c"),
            (None, base, "a"), (None, "nobody knows", "a"), (10, prose(3, 30_000), "d")]
    docs = docs_of(rows, "fingerprint component_id fp")
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    for i, text, _ in rows:
        assert f"{plain_fingerprint(text):016x}" in {f for f, _ in by[i]}
    assert {by[i][0][1] for i in (2, 4, 6)} == {2}
    assert by[8] == [by[7][0]] * 2 and by[7][0][1] == 7
    if (plain_fingerprint(base) ^ plain_fingerprint(near)).bit_count() <= 4:
        assert by[5][0][1] == by[3][0][1] == 3
    assert {c for _, c in by[None]} == {None, by[9][0][1]}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(
        {i for i in by if i is not None and by[i][0][1] == i})
    assert ids.count(None) == 2


def test_repeated_ids_in_several_components(spark, docs_of, prose):
    a, b, c, d = (prose(40 + k, 60) for k in range(4))
    docs = docs_of([(5, a, "s"), (5, b, "s"), (5, a, "s"), (6, a, "s"), (6, b, "s"), (3, c, "s"), (7, c, "s"),
                    (7, d, "s"), (8, c, "s"), (9, d, "s"), (None, d, "s")], "fp _key")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in kept.collect()))
    assert got == sorted([(5, a), (5, b), (3, c), (7, d), (0, d)])


def test_empty_table(spark, docs_of):
    empty = docs_of([]).where("false")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0


def test_hot_copies_stay_whole(spark, docs_of, prose):
    text = prose(4, 60)
    docs = docs_of([(i, text if i % 3 == 0 else prose(100 + i, 40), "s") for i in range(300)])
    out = simhash.near_duplicates(docs)
    assert out.count() == 300
    assert out.where(F.col("doc_id") % 3 == 0).select("component_id").distinct().count() == 1


def test_growing_tables_are_not_broadcast(spark, docs_of, prose, monkeypatch):
    # Spark's estimate of the probes is that of the fingerprints they are exploded from
    plans = {}

    def seen(name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()

    def recorded(df, name, write=common.stored):
        seen(name, df)
        return write(df, name)

    monkeypatch.setattr(common, "stored", recorded)
    monkeypatch.setattr(simhash, "stored", recorded)
    rows = [(k, prose(k, 40), "s") for k in range(8)] + [(8, prose(0, 40), "s"), (5, prose(0, 40), "s")]
    docs = docs_of(rows)                        # id 5 twice
    distinct = spark.createDataFrame([(k,) for k in range(40)], "fp long")
    with common.Scratch() as scratch:
        distinct = scratch.store(distinct, "fps")
        seen("links", simhash.link_fingerprints(scratch, distinct, 40, radius=1, hot=2))
    seen("kept", simhash.keep_first(docs, radius=1, hot=2))
    assert {"simhash-met", "simhash-rooted", "simhash-components"} <= set(plans)
    for name, plan in plans.items():
        if not name.startswith("cc-"):
            # the one table sent to all is that of the crowded values
            sent = re.findall(r"BroadcastHashJoin (.*)", plan)
            assert all(re.fullmatch(r"\[key#\d+L(, seg#\d+)?\], \[key#\d+L(, seg#\d+)?\], (Inner|LeftAnti), "
                                    r"BuildRight, false", of) for of in sent), (name, sent)
            assert "BroadcastNestedLoopJoin" not in plan
