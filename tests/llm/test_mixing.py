from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction
from math import ceil, log2

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing as M


def brute_schedule(shares: dict[str, int], blocks: dict[str, int]) -> dict[tuple[str, int], int]:
    """Slot of each (source, block), slot by slot, by earliest deadline first."""
    slot, out, t = {s: 0 for s in shares}, {}, 0
    while any(slot[s] < blocks[s] for s in shares):
        live = [s for s in sorted(shares) if slot[s] < blocks[s]]
        total, done, begin = sum(shares[s] for s in live), {s: 0 for s in live}, t
        while all(slot[s] < blocks[s] for s in live):
            ready = [s for s in live if done[s] * total // shares[s] <= t - begin]
            due = {s: -((done[s] + 1) * total // -shares[s]) for s in ready}
            s = min(ready, key=lambda s: (due[s], s))
            out[s, slot[s]] = t
            slot[s] += 1
            done[s] += 1
            t += 1
    return out


CASES = [({"a": 1, "b": 1}, {"a": 3, "b": 5}), ({"a": 5, "b": 3, "c": 2}, {"a": 31, "b": 7, "c": 40}),
         ({"a": 10, **{f"s{k}": 1 for k in range(10)}}, {"a": 60, **{f"s{k}": 2 + k for k in range(10)}}),
         ({"a": 7}, {"a": 9}), ({"a": 3, "b": 4, "c": 5}, {"a": 1, "b": 1, "c": 1})]


def shares_of(weights: dict[str, float], blocks: dict[str, int]) -> dict[str, int]:
    """The weights as the fixed-point integers of the schedule."""
    bits = min(M.WEIGHT_BITS, 61 - ceil(log2(sum(blocks.values()) + 1)))
    total = sum(weights[s] for s in sorted(weights))
    return {s: max(1, int(2 ** bits * w / total + 0.5)) for s, w in weights.items()}


def library_order(spark, weights, blocks) -> list[tuple[int, str, int]]:
    rows = spark.createDataFrame([(s, float(weights[s]), blocks[s]) for s in weights], "src string, weight double, blocks long")
    return sorted((r["slot"], r["src"], r["block"]) for r in M.slots(rows).collect())


@pytest.mark.parametrize("shares, blocks", CASES)
def test_schedule_equals_brute_force(spark, shares, blocks):
    got = library_order(spark, shares, blocks)
    assert {(s, b): t for t, s, b in got} == brute_schedule(shares_of(shares, blocks), blocks)
    assert [t for t, _, _ in got] == list(range(sum(blocks.values())))


@pytest.mark.parametrize("shares, blocks", CASES)
def test_deviation_stays_below_one_block(spark, shares, blocks):
    """Of the library's own schedule, at every slot."""
    left, done, t, live = dict(blocks), defaultdict(int), 0, set(shares)
    for _, s, _ in library_order(spark, shares, blocks):
        left[s] -= 1
        done[s] += 1
        t += 1
        total = sum(shares[x] for x in live)
        assert all(abs(done[x] - Fraction(shares[x] * t, total)) < 1 + Fraction(1, 10 ** 6) for x in live)
        if not left[s]:
            live, done, t = {x for x in live if left[x]}, defaultdict(int), 0


@pytest.mark.parametrize("weights, blocks", [
    ({"a": 0.7, "b": 0.29955, "c": 0.00035, "d": 0.0001}, {"a": 2900, "b": 2000, "c": 40, "d": 1}),
    ({f"s{k:02}": (k + 1) ** 0.7 for k in range(20)}, {f"s{k:02}": 20 + 9 * k for k in range(20)})])
def test_deviation_from_the_weights_on_a_long_schedule(spark, weights, blocks):
    rows = spark.createDataFrame([(s, weights[s], blocks[s]) for s in weights], "src string, weight double, blocks long")
    got = sorted((r["slot"], r["src"], r["block"]) for r in M.slots(rows).collect())
    assert [t for t, _, _ in got] == list(range(sum(blocks.values())))
    placed, done, t, live = defaultdict(int), defaultdict(int), 0, set(weights)
    for _, s, block in got:
        assert block == placed[s]
        placed[s] += 1
        done[s] += 1
        t += 1
        total = sum(weights[x] for x in live)
        assert all(abs(done[x] - weights[x] / total * t) < 1 + 1e-6 for x in live)
        if placed[s] == blocks[s]:
            live, done, t = live - {s}, defaultdict(int), 0


def test_default_slots_are_those_of_the_weights(spark, docs_of, prose):
    """Shares of a period of 1,000 slots give the light source its first block by slot 1,000."""
    docs = docs_of([(i, prose(i, 30), "a") for i in range(150)] + [(500, prose(1, 30), "b")])
    weights = spark.createDataFrame([("a", 0.9999), ("b", 0.0001)], "source string, weight double")
    placed, _ = M.place(docs, weights, block_size=2)
    out = placed.select("mix.source", "mix.slot").collect()
    assert len(out) == 151 and max(r["slot"] for r in out if r["source"] == "a") > 10_000
    assert 9000 < min(r["slot"] for r in out if r["source"] == "b") < 10_000


def test_documents(spark, docs_of, prose):
    rows = [(i, prose(i, 20 + i % 50), "hot" if i % 3 == 0 else f"src{i % 7}") for i in range(200)]
    rows += [(300, None, "src1"), (301, "", None), (302, prose(1, 30), None), (303, prose(2, 5000), "long"),
             (5, rows[5][1], rows[5][2]), (None, "no id", "src2"), (304, "x", "")]
    docs = docs_of(rows, "mix slot block src start key size weight _size _src _key _doc _id _range _base _block _x")
    placed, name = M.place(docs, block_size=700)
    assert name == "mix_"
    out = placed.collect()
    assert len(out) == len(rows)
    # blocks: documents of a source in key order, cut by their start
    by = defaultdict(list)
    for i, text, source in rows:
        key = int(hashlib.md5(":".join(x for x in (None if i is None else str(i), text) if x is not None).encode())
                  .hexdigest()[:15], 16)
        by["" if source is None else "=" + source].append((key, i is not None, i or 0, len(text or "")))
    want, sizes = [], {}
    for src, docs_in in by.items():
        at = 0
        for key, known, i, size in sorted(docs_in):
            want.append((src, at // 700, at, i if known else None))
            at += size
        sizes[src] = at
    weight = {s: (sizes[s] + 1) ** M.TEMPERATURE for s in sizes}
    blocks = {s: sizes[s] // 700 + 1 for s in sizes}
    slots = brute_schedule(shares_of(weight, blocks), blocks)
    want = sorted((s[1:], b, slots[s, b], at, i if i is not None else -9) for s, b, at, i in want)
    got = sorted((r[name]["source"], r[name]["block"], r[name]["slot"], r[name]["start"],
                  r["doc_id"] if r["doc_id"] is not None else -9) for r in out)
    assert got == want
    mixed = M.mixed(docs, block_size=700)
    assert mixed.columns == docs.columns
    rank = defaultdict(list)                # repeated rows have a place each
    for r in out:
        rank[r["doc_id"], r["text"]].append((r[name]["slot"], r[name]["start"], r[name]["key"]))
    order = [rank[r["doc_id"], r["text"]][0] for r in mixed.collect() if r["doc_id"] != 5]
    assert len(order) == len(rows) - 2 and order == sorted(order)


def test_the_number_of_blocks_is_bounded(spark, docs_of, prose):
    """A large corpus gets larger blocks: all rows are placed, in few slots."""
    docs = docs_of([(i, prose(i, 30), "abc"[i % 3]) for i in range(150)])
    placed, _ = M.place(docs, block_size=10, max_blocks=12)
    out = placed.select("mix.source", "mix.block", "mix.slot").collect()
    slots = {r["slot"] for r in out}
    assert len(out) == 150 and 12 <= len(slots) <= 15 and len({(r["source"], r["block"]) for r in out}) == len(slots)
    assert sum(1 for _ in M.place(docs, block_size=10)[0].select("mix.slot").distinct().collect()) > 100


def test_explicit_weights(spark, docs_of, prose):
    docs = docs_of([(i, prose(i, 30), "ab"[i % 2]) for i in range(120)] + [(500, prose(1, 30), "c")])
    weights = spark.createDataFrame([("a", 0.75), ("b", 0.25), ("zzz", 9.0), ("c", None), ("a", 0.0)],
                                    "source string, weight double")
    placed, _ = M.place(docs, weights.where("source != 'zzz'"), block_size=200)
    slots = {(r["mix"]["source"], r["mix"]["slot"]) for r in placed.collect()}
    early = [s for s, t in slots if t < 40]
    assert 2.5 * early.count("b") <= early.count("a") <= 3.5 * early.count("b")


def test_native_plan_and_empty_table(spark, docs_of, prose):
    docs = docs_of([(i, prose(i, 30), "ab"[i % 2]) for i in range(20)])
    plan = M.place(docs)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert M.place(docs.where("false"))[0].count() == 0
    assert M.mixed(docs.where("false")).count() == 0


def test_hot_source_is_spread(spark, docs_of):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.lit("some words here").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"))
    placed, _ = M.place(docs, block_size=1000)
    assert placed.select("mix.source", "mix.start").distinct().count() == 30_000
