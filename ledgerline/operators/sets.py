"""Semi and anti joins with SQL's NOT IN, and differences of multisets.

``not_in`` follows SQL: a null among the excluded keys leaves nothing, a null key
is kept only when nothing is excluded. The two questions about the excluded side
are one small aggregate; the rest is a plain hash or merge anti join on the key,
which adaptive execution may split, instead of a nested loop.

``reconcile`` compares two loads as multisets: each side adds its signed count
per distinct row, nulls being equal, and one aggregation of both tells what was
lost, added or kept. Nothing is sorted and no row meets another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def not_in(df: DataFrame, key: str, excluded: DataFrame, excluded_key: str) -> DataFrame:
    """The rows of ``df`` for which ``key NOT IN (excluded)`` is true."""
    keys = excluded.select(F.col(excluded_key).alias("_x"))
    facts = keys.agg(F.count("*").alias("n"), F.count_if(F.col("_x").isNull()).alias("gaps")).first()
    if facts["n"] == 0:
        return df
    if facts["gaps"]:
        return df.where("false")
    # distinct keys: a hot excluded key is one row
    return df.where(F.col(key).isNotNull()).join(keys.distinct(), F.col(key) == F.col("_x"), "left_anti")


def reconcile(old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``columns`` (default: all of ``old``) with ``n_old``, ``n_new``: how
    often each distinct row is in either load."""
    columns = list(columns or old.columns)
    both = (old.select(*columns, F.lit(1).alias("_o"), F.lit(0).alias("_n"))
            .unionByName(new.select(*columns, F.lit(0).alias("_o"), F.lit(1).alias("_n"))))
    return both.groupBy(*columns).agg(F.sum("_o").alias("n_old"), F.sum("_n").alias("n_new"))


def except_all(counts: DataFrame) -> DataFrame:
    """The rows of the old load that the new one lacks, as often as it lacks them."""
    columns = [c for c in counts.columns if c not in ("n_old", "n_new")]
    missing = F.col("n_old") - F.col("n_new")
    return counts.where(missing > 0).select(*columns, F.explode(F.sequence(F.lit(1), missing.cast("int"))).alias("_k")).drop("_k")


def intersect_all(counts: DataFrame) -> DataFrame:
    """The rows that both loads have, as often as both have them."""
    columns = [c for c in counts.columns if c not in ("n_old", "n_new")]
    shared = F.least("n_old", "n_new")
    return counts.where(shared > 0).select(*columns, F.explode(F.sequence(F.lit(1), shared.cast("int"))).alias("_k")).drop("_k")


def reconciliation(counts: DataFrame) -> DataFrame:
    """The rows that differ: their counts and what became of them."""
    return counts.where("n_old <> n_new").withColumn(
        "change", F.when(F.col("n_new") == 0, "lost").when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") < F.col("n_old"), "fewer").otherwise("more"))
