from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings, strategies as st

from ledgerline.llm import decontaminate as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for k in range(len(v) - n + 1) if v else ():
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == v[k:k + n]:
                        hit.update(range(at, at + n))
                        found.add(str(item) if item is not None else "")
        out.append((i, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def tables(spark, docs, items):
    return (spark.createDataFrame([(i, t, "n_words") for i, t in docs], "doc_id long, text string, n_words string"),
            spark.createDataFrame(items, "item_id long, text string"))


def fixture(prose):
    long = prose(1, 60)
    items = [(3, prose(2, 25)), (12, prose(3, 14)), (100, "Short  item-here"), (7, None), (8, ""), (9, "!!"),
             (3, prose(2, 25)), (None, "no item id at all"), (21, "Été naïve"), (22, "SHORT item HERE")]
    docs = [(1, long), (2, None), (3, ""), (4, long + " " + prose(2, 25).upper() + " tail"),
            (5, "a short ITEM here " * 3), (6, prose(3, 14).replace(" ", "--")), (7, prose(2, 25)[20:] + long),
            (7, prose(2, 25)[20:] + long), (8, "x Été naïve y été naïve"),
            (None, "no item id at all"), (10, prose(9, 20_000) + "\n" + prose(3, 14))]
    return docs, items


def test_digest_equals_brute_force(spark, prose):
    docs, items = fixture(prose)
    d, b = tables(spark, docs, items)
    key = lambda r: tuple((x is not None, x) for x in r)
    for limit in (D.MAX_ITEM_BYTES, 250):       # one group of items, or several
        got = sorted(map(tuple, D.leak_digest(D.find_leaks(d, b, max_item_bytes=limit)).collect()), key=key)
        assert got == sorted(brute(docs, items), key=key)


def test_removal(spark, prose):
    docs, items = fixture(prose)
    d, b = tables(spark, docs, items)
    hit = {r[0] for r in brute(docs, items) if r[5]}
    for limit in (D.MAX_ITEM_BYTES, 250):
        kept = D.remove_leaks(d, b, max_item_bytes=limit)
        assert kept.columns == d.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in docs if i not in hit)
        cut = {r["doc_id"]: r["text"] for r in D.remove_leaks(d, b, "spans", max_item_bytes=limit).collect()}
        for i, t in docs:
            if i not in hit:
                assert cut[i] == t
        assert cut[4].startswith(prose(1, 60)) and cut[4].endswith(" tail")
        assert cut[8].split() == ["x", "y", "été", "naïve"]


def test_spans_count_characters(spark):
    d = spark.createDataFrame([(1, "ab one two three cd", 19), (2, None, None)],
                              "doc_id long, text string, n_chars long")
    b = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in D.remove_leaks(d, b, "spans").collect()}
    assert got == {1: ("ab  cd", 6), 2: (None, None)}


def test_empty_tables(spark, prose):
    docs, items = fixture(prose)
    d, b = tables(spark, docs, items)
    assert D.find_leaks(d.where("false"), b).count() == 0
    assert D.find_leaks(d, b.where("false")).where("size(items) > 0").count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abc"), max_size=14),
       st.integers(1, 6))
def test_scan_equals_brute_force(doc, item, window):
    index = D.ItemIndex([("1", " ".join(item).encode())], window)
    (n, hits, found), = D._scan([" ".join(doc).encode()], index)
    want, = brute([(1, " ".join(doc))], [(1, " ".join(item))], window)
    assert (n, len(hits), len(found)) == want[1:4]


def test_the_index_is_bounded_by_the_items(prose):
    """Driver and worker hold some 30 bytes a word and the sieve, also while it is built."""
    import pickle
    import tracemalloc
    rng = random.Random(2)
    items = [(str(k), " ".join(f"w{rng.randrange(10 ** 7)}" for _ in range(500)).encode()) for k in range(1000)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    index = D.ItemIndex(items, 10)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    per_byte = D.MAX_ITEM_BYTES / size
    cache = D.CACHED_WORDS * 200
    assert (len(pickle.dumps(index)) * per_byte) < 150e6
    assert (most - cache) * per_byte + cache < 500e6
    text = b" ".join([b"x y z", items[7][1][:300], b"tail"])
    (n, hits, found), = D._scan([text], index)
    assert list(found) == [index.ids.index("7")] and hits[0] == 3


def test_a_window_of_many_items_lists_them_all():
    shared = "one two three four five six seven eight nine ten"
    index = D.ItemIndex([(str(k), (shared + f" own{k} " + shared).encode()) for k in range(50)], 10)
    (n, hits, found), = D._scan([("a " + shared + " b").encode()], index)
    assert len(found) == 50 and hits.tolist() == list(range(1, 11))
    assert all(len(w.hashes) == len(set(zip(w.hashes.tolist(), w.owners.tolist()))) for w in index.windows)
