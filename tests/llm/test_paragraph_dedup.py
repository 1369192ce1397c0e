from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import paragraph_dedup as P

from .conftest import components

LONG = 10_000


def plain_anchors(h, window):
    out = set()
    for a in range(len(h) - window + 1):
        least = min(h[a:a + window])
        out |= {p for p in range(a, a + window) if h[p] == least}
    return sorted(p for p in out if p == 0 or h[p] != h[p - 1])


def plain_paragraphs(h):
    first, stops = plain_anchors(h, P.START_WINDOW), plain_anchors(h, P.STOP_WINDOW)
    ends = [next((e for e in stops if e >= s + P.LEAST), None) for s in first]
    return [(s, e) for s, e in zip(first, ends) if e is not None]


def brute(rows):
    """Spans by all pairs of paragraphs, in plain Python but for the hashes."""
    places = []
    for i, text in sorted(set((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (text or "").lower().split()
        h = P.shingle_hashes((text or "").encode(), P.Words()).tolist()
        places += [(i, text, s, e - s + 4, {tuple(words[k:k + 5]) for k in range(s, e)}) for s, e in plain_paragraphs(h)]
    links = [(a, b) for b in range(len(places)) for a in range(b)
             if 100 * len(places[a][4] & places[b][4]) >= 80 * len(places[a][4] | places[b][4])]
    root, groups = components(len(places), links), {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(k)
    spans = {}
    for members in groups.values():
        same = len({places[k][:2] for k in members}) == 1
        at = [places[k][2] for k in members]
        if same and max(at) - min(at) < P.MOST + 4:
            continue
        head = places[members[0]]
        for k in members:
            i, text, s, n, _ = places[k]
            removed = not ((i, text) == head[:2] and abs(s - head[2]) < P.MOST + 4)
            spans.setdefault((i, text, removed), []).append((s, s + n))
    out = set()
    for (i, _, removed), parts in spans.items():
        joined = []
        for a, z in sorted(parts):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], z)
            else:
                joined.append([a, z])
        out |= {(i, a, z - a, removed) for a, z in joined}
    return out


def changed(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def found(docs, **options):
    return {(r["doc_id"], r["start_word"], r["n_words"], r["removed"]) for r in P.find_repeats(docs, **options).collect()}


def test_bands_are_tuned():
    bands, rows = P.tune_bands()
    assert bands <= P.MAX_BANDS and 1 - (1 - 0.8 ** rows) ** bands >= P.RECALL
    assert P.tune_bands((100, 100), 0.999)[0] == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=120), st.sampled_from([1, 2, 8, 20]))
def test_anchors_equal_plain_windows(values, window):
    h = np.array(values, np.uint64)
    assert np.flatnonzero(P.anchors(h, window)).tolist() == (plain_anchors(values, window) if values else [])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 70), st.integers(0, 70))
def test_a_run_of_51_words_shares_a_paragraph_in_any_surroundings(seed, before, after):
    """Hundreds of seeds: the copied run shares a whole paragraph nearly always,
    and always when nothing at its border is an anchor more."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    run = [word() for _ in range(60)]
    texts = [" ".join([*(word() for _ in range(x)), *run, *(word() for _ in range(after))]).encode()
             for x in (before, before + 13)]
    hashes = [P.shingle_hashes(t, P.Words()) for t in texts]
    shared = [set(zip(*(x.tolist() for x in P.digests(h, *P.paragraphs(h)[:2])))) for h in hashes]
    assert shared[0] & shared[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63), min_size=1, max_size=200), st.integers(1, 4), st.integers(1, 3))
def test_combined_minima_equal_those_of_the_shingles(values, bands, rows):
    h = np.array(values, np.uint64)
    first, last, stops, begin = P.paragraphs(h)
    if not len(first):
        return
    got = P.band_keys(h, stops, begin, np.searchsorted(stops, last), bands, rows)
    for k, (a, z) in enumerate(zip(first, last)):
        alone = P.band_keys(h[a:z], np.array([0]), np.array([0]), np.array([1]), bands, rows)
        assert got[k].tolist() == alone[0].tolist()
        assert P.LEAST <= z - a


ALL = {"tuned": (24, 1)}            # every similar pair meets: what is tested is the rest


@pytest.mark.parametrize("chunk", [3, P.CHUNK])
def test_spans_equal_brute_force(spark, docs_of, prose, chunk):
    text = lambda seed, n: prose(seed, n, LONG)
    hot, pair = text(1, 60), text(2, 90)
    rows = [(i, text(100 + i, 50 + i) + " " + text(300, 20), "s") for i in range(8)]
    rows += [(20 + i, text(500 + i, 45) + "\n" + hot.upper() + " " + text(600 + i, 30), "s") for i in range(5)]
    rows += [(30 + i, text(700 + i, 20) + " " + changed(hot, i, 1), "s") for i in range(6)]
    rows += [(50, pair, "s"), (51, "x\n" + changed(pair, 7, 2) + "\n", "s"), (52, pair + "\n" + pair, "s"),
             (60, None, None), (61, "", "s"), (62, "\n\n", "s"), (63, text(9, 700), "s"), (64, text(9, 700), "s"),
             (5, rows[5][1], "s"), (None, pair, "s"), (70, "w " * 60, "s"), (71, "W " * 50, "s"),
             (72, "a b c " * 40, "s"), (2, hot, "s"), (None, text(10, 80), "s")]
    docs = docs_of(rows, "start_word removed row id bands place first n")
    assert found(docs, chunk=chunk, **ALL) == brute(rows)


def test_wrapped_and_embedded_passages_are_caught(spark, docs_of, prose):
    """60 words over lines of 12, in the middle of a long line, and with other white space."""
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    words = passage.split()
    wrapped = "\n".join(" ".join(words[k:k + 12]) for k in range(0, 60, 12))
    rows = [(1, prose(1, 300, LONG) + " " + passage + " " + prose(2, 300, LONG), "s"),
            (2, prose(3, 30, 9) + "\n" + wrapped + "\n" + prose(4, 30, 9), "s"),
            (3, prose(5, 2000, LONG) + " " + passage.upper().replace(" ", "\t ") + " end", "s"),
            (4, prose(6, 400, LONG), "s"), (5, prose(7, 60), "s")]
    got = found(docs_of(rows))
    assert {i for i, *_ in got} == {1, 2, 3} and {i for i, *_, removed in got if removed} == {2, 3}
    for i, start, n, _ in got:
        at = {1: 300, 2: 30, 3: 2000}[i]
        assert at - 3 <= start and start + n <= at + 63 and n >= 24      # near paragraphs reach a little over
    kept = {r["doc_id"]: r["text"] for r in P.remove_repeats(docs_of(rows)).collect()}
    assert kept[1] == rows[0][1] and kept[4] == rows[3][1]
    gone = {k for i, s, n, removed in got if i == 2 and removed for k in range(s, s + n)}
    assert kept[2].split() == [w for k, w in enumerate(rows[1][1].split()) if k not in gone]
    assert not any(w in kept[2] for w in words[25:35])


def test_recall_on_planted_passages(spark, docs_of):
    """At production bands, in random surroundings, 51 words and more."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**7)}"
    rows, planted = [], set()
    for k in range(150):
        passage = [word() for _ in range(rng.randrange(51, 90))]
        for copy in range(2):
            i = 2 * k + copy
            rows.append((i, " ".join([*(word() for _ in range(rng.randrange(200))), *passage,
                                      *(word() for _ in range(rng.randrange(200)))]), "s"))
            planted.add(i)
    rows += [(1000 + k, " ".join(word() for _ in range(200)), "s") for k in range(100)]
    caught = {i for i, *_ in found(docs_of(rows))}
    assert len(caught & planted) >= 0.97 * len(planted) and not caught - planted


def test_rows_of_one_id_are_cut_each_by_its_own_text(spark, docs_of, prose):
    passage = prose(1, 80, LONG)
    own = [prose(20 + k, 70, LONG) for k in range(4)]
    rows = [(1, passage, "s"), (2, own[0] + " " + passage, "s"), (2, own[1], "s"), (None, own[2] + " " + passage, "s"),
            (None, own[3], "s"), (3, None, "s")]
    docs = docs_of(rows, "cut _cut _row _key _doc _found")
    kept = P.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    texts = [r["text"] for r in kept.collect()]
    # the null id sorts first, so its passage stays; rows without a repeat are whole
    for whole in (own[1], own[3], rows[3][1], None):
        assert whole in texts
    assert passage not in texts and rows[1][1] not in texts
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in kept.collect())


def test_a_large_family_is_one_passage(spark, docs_of, prose):
    """Variants round one wording, in buckets dealt into many chunks."""
    base = prose(1, 80, LONG)
    docs = docs_of([(i, changed(base, i, 1), "s") for i in range(1, 300)] + [(0, base, "s")]
                   + [(900 + i, prose(50 + i, 80, 99), "s") for i in range(3)])
    out = P.find_repeats(docs, chunk=20).collect()
    assert {r["doc_id"] for r in out if r["removed"]} == set(range(1, 300))
    assert {r["first_doc_id"] for r in out if r["removed"]} <= set(range(3))


def test_both_join_forms_give_the_same(spark, docs_of, prose, monkeypatch):
    passage = prose(1, 80, LONG)
    docs = docs_of([(i, prose(50 + i, 40, LONG) + " " + passage + " " + prose(90 + i, 40, LONG), "s") for i in range(6)])
    small = found(docs)
    monkeypatch.setattr(P, "MAX_BROADCAST_BYTES", 0)
    assert found(docs) == small and len({i for i, *_ in small}) == 6


def test_empty_table(spark, docs_of):
    empty = docs_of([]).where("false")
    assert P.find_repeats(empty).count() == 0
    assert P.remove_repeats(empty).count() == 0
