from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import quality_classifier as QC, quality_rules as QR
from ledgerline.llm.lexical import MARKS, WordHash


def brute_base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n\t\x0b\x1c#|", max_size=120))
def test_base_counts(text):
    assert QR.base_counts(text.encode()) == brute_base(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=60))
def test_repeated_words(words):
    assert QR.repeated_words(words) == brute_base(b" ".join(words).decode())[4]


def quality_rows(prose):
    good = [(i, prose(i, 60 + i), "s") for i in range(40)]
    junk = [(100 + i, "$$$ ".join(prose(500 + i, 60).split()), "s") for i in range(12)]
    odd = [(200, None, None), (201, "", "s"), (202, "few words", "s"), (203, "again and " * 40, "s"),
           (1, good[1][1], "s"), (None, good[2][1], "s"), (204, prose(9, 25_000), "s")]
    return good + junk + odd


def grams(text):
    for mark in MARKS:
        text = text.replace(mark.decode(), f" {mark.decode()} ")
    h = [zlib.crc32(w.encode()) for w in text.lower().split()]
    phi = 0x9E3779B97F4A7C15
    pairs = [((a * phi + b + 1) * phi % 2**64) >> 33 for a, b in zip(h, h[1:])]
    return [x % QR.BUCKETS for x in h + pairs]


def test_rules_equal_brute_force(spark, docs_of, prose):
    rows = quality_rows(prose)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)] * 2 + [(100, 0, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = QR.apply_rules(docs_of(rows, "kept score n_words"), labels).collect()
    assert len(out) == len(rows)
    raw, target = Counter(), Counter()
    for i, t, _ in rows:
        g = Counter(grams(t or ""))
        raw += g
        if i is not None and i < 40 and i % 2 == 0:
            target += g
    share = lambda c: {b: math.log((c[b] + .5) / (sum(c.values()) + .5 * QR.BUCKETS)) for b in raw}
    p, q = share(target), share(raw)
    want = Counter()
    for i, t, _ in rows:
        g = grams(t or "")
        score = sum(p[b] - q[b] for b in g) / len(g) if g else 0.0
        base = brute_base(t)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want[(i, *base, round(score, 9), failed, not failed and score >= QR.MIN_SCORE)] += 1
    got = Counter((r[0], *r[1:6], round(r["score"], 9), r["base_failed"], r["kept"]) for r in out)
    assert got == want
    score = {r["doc_id"]: r["score"] for r in out}
    assert min(score[i] for i in range(0, 40, 2)) > max(score[100 + i] for i in range(12))


def test_rules_keep_good_documents(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in QR.apply_rules(docs, labels).collect()}
    rows = [(r["quality"], out[r["doc_id"]]) for r in labels.collect()]
    passed = [(q, r["kept"]) for q, r in rows if not r["base_failed"]]
    assert all(kept for q, kept in passed if q)
    assert sum(kept for q, kept in passed if not q) <= 0.1 * sum(not q for q, _ in passed)


def test_rules_without_labels_or_rows(spark, docs_of, prose):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = QR.apply_rules(docs_of([(1, prose(1, 50), "s"), (2, "short", "s")]), labels).collect()
    assert {r["doc_id"]: r["kept"] for r in out} == {1: True, 2: False}
    assert QR.apply_rules(docs_of([]).where("false"), labels).count() == 0


@pytest.fixture(scope="module")
def scored(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = QC.train(docs, labels)
    return docs, labels, model, QC.digest(QC.score(docs, model)).collect()


def test_classifier_held_out(scored):
    docs, labels, _, out = scored
    assert len(out) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(r["score"], truth[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9
    assert np.mean([(s - y) ** 2 for s, y in held]) < 0.08          # calibrated


def test_held_out_labels_are_never_read(spark, scored):
    docs, labels, _, out = scored
    flipped = labels.withColumn("quality", F.when(QC.held_out("doc_id"), 1 - F.col("quality"))
                                .otherwise(F.col("quality"))).repartition(7)
    again = QC.score(docs.repartition(5), QC.train(docs.repartition(5), flipped)).collect()
    before = {r["doc_id"]: r["score"] for r in out}
    assert max(abs(before[r["doc_id"]] - r["score"]) for r in again) < 1e-6


def test_context_vectors_equal_brute_force():
    places, signs = QC.index_vectors()
    rng = np.random.default_rng(1)
    words = rng.integers(0, 30, 50)
    total = np.zeros(QC.BUCKETS * QC.DIMENSIONS, dtype=np.int64)
    gap = np.full(QC.REACH, -1)
    QC.add_contexts(total, np.concatenate([words[:20], gap, words[20:], gap]), places, signs)
    want = np.zeros((QC.BUCKETS, QC.DIMENSIONS), dtype=np.int64)
    for doc in (words[:20], words[20:]):
        for i in range(len(doc)):
            for j in range(len(doc)):
                if i != j and abs(i - j) <= QC.REACH:
                    np.add.at(want[doc[i]], places[doc[j]], signs[doc[j]])
    assert (total.reshape(want.shape) == want).all()


def plain_features(text, vectors):
    """Mean, mean square and length of the mean, word by word."""
    for mark in "#*$%&|<>!":
        text = text.replace(mark, f" {mark} ")
    words = text.encode().split()
    found = [vectors[zlib.crc32(w) % QC.BUCKETS].astype(float) for w in words]
    if not found:
        return [0.0] * (2 * QC.DIMENSIONS + 1)
    mean = [sum(v[d] for v in found) / len(found) for d in range(QC.DIMENSIONS)]
    square = [sum(v[d] ** 2 for v in found) / len(found) for d in range(QC.DIMENSIONS)]
    return mean + square + [sum(m * m for m in mean) ** 0.5]


def plain_score(x, model):
    """The network one unit at a time."""
    x = [(a - m) / s for a, m, s in zip(x, model.mean, model.scale)]
    hidden = [np.tanh(sum(a * w for a, w in zip(x, model.w1[:, j])) + model.b1[j]) for j in range(len(model.b1))]
    return 1 / (1 + np.exp(-(sum(h * w for h, w in zip(hidden, model.w2)) + model.b2) / model.temperature))


def test_pooling_and_scores_equal_brute_force(spark, scored):
    docs, _, model, out = scored
    rows = docs.where("doc_id < 40").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    scores = {r["doc_id"]: r["score"] for r in out}
    for i, text in [*texts.items(), (None, ""), (None, "a!b  c#\n")]:
        want = plain_features(text, model.vectors)
        got = model.features([text.encode()], WordHash())
        assert np.allclose(got[0], want, atol=1e-4)
        assert abs(plain_score(want, model) - model.scores(got)[0]) < 1e-3
        assert i is None or abs(scores[i] - plain_score(want, model)) < 1e-3


def test_classifier_odd_rows(spark, docs_of, prose, scored):
    _, _, model, _ = scored
    rows = quality_rows(prose)
    docs = docs_of(rows, "score")
    out = QC.score(docs, model).collect()
    assert len(out) == len(rows)
    empty = {r["score"] for r in out if r["doc_id"] in (200, 201)}
    assert len(empty) == 1
    kept = QC.accept(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in out if r["score"] >= QC.THRESHOLD)
    assert QC.score(docs.where("false"), model).count() == 0


@pytest.mark.parametrize("quality, share", [([], 0.5), ([1] * 30, 0.99), ([0] * 30, 0.01)])
def test_classifier_without_two_classes(spark, docs_of, prose, quality, share):
    docs = docs_of([(i, prose(i, 30), "s") for i in range(40)])
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(quality)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    scores = {round(r["score"], 6) for r in QC.score(docs, QC.train(docs, labels)).collect()}
    assert scores == {share}


def test_word_hash_is_bounded():
    h = WordHash()
    assert h[b"abc"] == zlib.crc32(b"abc") and h[b"abc"] == zlib.crc32(b"abc")
