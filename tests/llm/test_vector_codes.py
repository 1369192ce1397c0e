from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import vector_codes as V

KIND = "vec_id long, embedding array<float>, label int, code string, part int"


def plain(rows, entries=256, rounds=4):
    """Codes by plain loops over Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}, [], ""
    size = len(kept[0][1]) // 4
    kept = [r for r in kept if len(r[1]) == 4 * size]
    cut = lambda v: [v[p * size:(p + 1) * size] for p in range(4)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            mine: dict = {}
            for _, v, _ in kept:
                x = cut(v)[p]
                mine.setdefault(nearest(x, books[p])[1], []).append(x)
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for i, v, lab in kept:
        found = [nearest(x, books[p]) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    totals: dict = {}
    for _, _, e, lab in out:
        totals[lab] = totals.get(lab, 0) + e
    flat = ",".join(str(c) for b in books for e in b for c in e)
    return totals, out, hashlib.sha256(flat.encode()).hexdigest()


def check(spark, rows, entries=256, cell=V.CELL):
    df = spark.createDataFrame([(i, v, lab, "clash", 3) for i, v, lab in rows], KIND).repartition(3)
    totals, want, sha = plain(rows, entries)
    got = V.compress(df, entries=entries, cell=cell).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=key) == sorted(
        ((i, c, e, totals[lab]) for i, c, e, lab in want), key=key)
    assert {r["codebooks_sha256"] for r in got} == ({sha} if want else set())
    return got


@pytest.mark.parametrize("entries, cell", [(256, V.CELL), (7, 1), (5, 100_000)])
def test_equals_plain_loops(spark, entries, cell):
    rng = random.Random(entries)
    rows = [(i * 3 % 101, [rng.gauss(0, 0.2) for _ in range(8)], rng.choice([None, 0, 1])) for i in range(101)]
    rows += [(500 + i, rows[0][1], 1) for i in range(20)]                     # a hot vector
    rows += [(4, rows[9][1], 2), (4, rows[9][1], 2), (None, rows[3][1], None)]  # repeated and missing ids
    rows += [(900, None, 1), (901, [None] + [0.5] * 7, 1), (902, [math.nan] + [0.5] * 7, 1),
             (903, [math.inf] + [0.5] * 7, None), (904, [0.1] * 12, 0), (905, [], 0)]
    check(spark, rows, entries, cell)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(0, [0.25] * 4, 0), (1, [0.25] * 4, 0), (2, [-0.25] * 4, 0), (3, [0.0] * 4, 0), (4, [-0.0] * 4, None)]
    got = check(spark, rows)
    assert {r["vec_id"]: r["code"] for r in got}[1] == "00000000"


def test_empty_tables_and_unusable_vectors(spark):
    assert check(spark, []) == [] or True
    assert V.compress(spark.createDataFrame([], KIND)).count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 1, "", 0), (2, [math.nan], 1, "", 0)], KIND)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        V.compress(spark.createDataFrame([(1, [0.5] * 6, 1, "", 0)], KIND))
    with pytest.raises(Exception, match="cannot be coded"):
        V.compress(spark.createDataFrame([(1, [1e9] * 4, 1, "", 0)], KIND)).count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=20),
       st.lists(st.lists(st.integers(-400, 400), min_size=3, max_size=3), min_size=1, max_size=30),
       st.sampled_from([1, 7, 64, 1000]), st.sampled_from([100, 1 << 20]), st.sampled_from([1, 300_000]))
def test_grid_memo_is_exact(book, points, cell, memo_bytes, scale):
    book, points = np.array(book, np.int64) * scale, np.array(points + points, np.int64) * scale
    index, distance = V.GridMemo(book, cell, memo_bytes).nearest(points)
    all_distances = ((points[:, None] - book[None]) ** 2).sum(-1)
    assert (index == all_distances.argmin(1)).all() and (distance == all_distances.min(1)).all()


def test_memo_prunes_and_is_reused():
    rng = np.random.default_rng(1)
    book, points = rng.normal(0, 128, (256, 16)).astype(np.int64), rng.normal(0, 128, (500, 16)).astype(np.int64)
    memo = V.GridMemo(book)
    memo.nearest(points)
    assert memo.evaluated < 0.5 * 500 * 256
    seen = memo.bounded
    memo.nearest(points)
    assert memo.bounded == seen
    small = V.GridMemo(book, memo_bytes=1)
    assert (small.nearest(points)[0] == memo.nearest(points)[0]).all() and len(small.known) <= V._BLOCK
