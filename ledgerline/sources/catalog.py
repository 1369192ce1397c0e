"""Registration and inspection helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str = "sales") -> str:
    """Expose the fact to ``spark.sql`` as a temporary view."""
    df.createOrReplaceTempView(name)
    return name


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` the same rows every time
    (a top-k, not a full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) rows - the printSchema / columns
    listing as data. Built from the schema only; no job runs."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")
