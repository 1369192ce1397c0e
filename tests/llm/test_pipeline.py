from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as CP
from ledgerline.llm.common import stored, table

from .conftest import components
from .test_decontaminate import brute as leaks_of
from .test_simhash import plain_fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output rows over the small tables."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in CP.STAGES:
        result = stored(stage(spark, docs, SMALL), "stage")
        out.append((name, docs, result))
        docs = result
    return out


def test_names_and_columns(spark, stages):
    assert [n for n, _, _ in stages] == [n for n, _ in CP.STAGES] and len(stages) == 5
    columns = table(spark, SMALL, "documents").columns
    assert all(out.columns == columns for _, _, out in stages[:-1])


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    label = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    good = [i for i, q in label.items() if q]
    bad = [i for i, q in label.items() if not q]
    assert kept < {r["doc_id"] for r in before.collect()}
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.5 * len(bad)


def test_near_dedup_stage(stages):
    _, before, after = stages[1]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    root = components(len(rows), [(a, b) for b in range(len(rows)) for a in range(b)
                                  if (prints[a] ^ prints[b]).bit_count() <= 4])
    want = [rows[k] for k in range(len(rows)) if root[k] == k]
    assert sorted((r["doc_id"], r["text"]) for r in after.collect()) == want and len(want) < len(rows)


def test_decontamination_stage(spark, stages):
    _, before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    clean = {x[0] for x in leaks_of(rows, items) if not x[5]}
    assert {r["doc_id"] for r in after.collect()} == clean and len(clean) < len(rows)


def test_mixing_and_token_stages(stages):
    from ledgerline.llm import mixing
    _, before, mixed = stages[3]
    assert sorted(before.collect()) == sorted(mixed.collect())
    placed, name = mixing.place(before)
    rank = {r["doc_id"]: (r[name]["slot"], r[name]["start"], r[name]["key"]) for r in placed.collect()}
    ordered, order = CP._stored_order(mixed)
    ids = [r["doc_id"] for r in ordered.orderBy(*order).collect()]
    assert [rank[i] for i in ids] == sorted(rank.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    got = sorted(stages[4][2].collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == ids
    at = 0
    for r in got:
        tokens = tokenizer.encode(text[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"]) == (at, len(tokens))
        assert r["ids_crc32"] == zlib.crc32(np.array(tokens, "<u4").tobytes())
        at += len(tokens)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(CP.run(spark, SMALL).collect()) == sorted(stages[4][2].collect())


def test_odd_rows(spark, docs_of, prose, tmp_path):
    """Nulls, empty texts, repeated rows, clashing columns and empty tables."""
    rows = [(i, prose(i, 60), f"s{i % 3}") for i in range(30)]
    rows += [(3, rows[3][1], "s0"), (40, None, None), (41, "", "s"), (None, prose(99, 40), None),
             (42, prose(5, 15_000), "s1"), (43, rows[4][1], "s2")]
    from pyspark.sql import functions as F
    docs = docs_of(rows, "score leaks mix fp component_id quality n _row")
    folder = str(tmp_path)
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(30)] + [(None, 1, 0), (2, None, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(7, 30)), (2, None), (None, "")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    for data in (docs, docs.where(F.lit(False))):
        now = data
        for k, (_, stage) in enumerate(CP.STAGES):
            result = stage(spark, now, folder)
            if k < 4:
                assert result.columns == data.columns
            now = stored(result, "stage")
        ids = [r["doc_id"] for r in now.collect()]
        assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
        assert 7 not in ids
