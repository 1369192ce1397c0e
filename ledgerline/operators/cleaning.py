"""Cleaning (P1, P2, T1-T4): header stripping, null tokens, null/NaN drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.config import DEFAULT_NULL_TOKENS


def strip_columns(df: DataFrame) -> DataFrame:
    """Strip surrounding spaces from every column name (' Region' -> 'Region')."""
    return df.toDF(*[c.strip() for c in df.columns])


def normalize_nulls(df: DataFrame, tokens: tuple[str, ...] = DEFAULT_NULL_TOKENS,
                    columns: list[str] | None = None) -> DataFrame:
    """Turn textual missing markers in string columns into real NULLs, as
    the pandas reader does: blank, or one of ``tokens`` in exactly its case."""
    targets = set(columns) if columns else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in targets:
            c = F.when((F.trim(c) == "") | c.isin(list(tokens)), F.lit(None).cast(f.dataType)) \
                 .otherwise(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def clean(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any (or ``subset``) column.

    Same as the reference's ``na.drop()``. Passing only the columns a query
    needs as ``subset`` keeps parquet column pruning intact (a whole-row test
    forces every column to be read).
    """
    return df.na.drop(how=how, subset=subset)


def clean_count(raw: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """Rows before and after ``clean``, in one row."""
    before = raw.select(F.lit(1).alias("rows_in"), F.lit(0).alias("rows_out"))
    after = clean(raw, how, subset).select(F.lit(0).alias("rows_in"), F.lit(1).alias("rows_out"))
    return before.unionByName(after).agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"))
