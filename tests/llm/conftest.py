from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text, source) rows, in a few partitions."""
    def make(rows, extra: str = ""):
        data = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(data, DOCS).repartition(3)
        for name in extra.split():
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture()
def prose():
    """Deterministic invented text of n words."""
    vocabulary = [a + b for a in "ka lo mi nu pe ra so ti vu za the and of in".split()
                  for b in ("", "na", "rel", "to", "shi", "den")]

    def make(seed: int, n: int, width: int = 12) -> str:
        rng = random.Random(seed)
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "\n".join(" ".join(words[i:i + width]) for i in range(0, n, width))
    return make


def components(n: int, links) -> list[int]:
    """Smallest member of each node's component, by plain union."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]
