"""JSON properties: discovered and typed by one aggregate, then read as columns.

``schema_of_variant_agg`` merges the schemas of all values as an aggregate (each
task sends one schema), so keys that only a few rows have are found too, and a key
that holds whole numbers here and fractions there gets a type for both. Text that
is no JSON object counts as no properties. Values are read with the discovered
type; what does not fit is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructType


def discover(df: DataFrame, column: str) -> StructType:
    """The merged schema of the JSON objects in ``column``."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return StructType([])
    kind = DataType.fromDDL(found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING"))
    return kind if isinstance(kind, StructType) else StructType([])


def as_columns(df: DataFrame, column: str, schema: StructType, prefix: str = "") -> DataFrame:
    """``df`` with one typed column per discovered key."""
    value = F.try_parse_json(column)
    return df.withColumns({prefix + f.name: F.try_variant_get(value, f"$['{f.name}']", f.dataType.simpleString())
                           for f in schema.fields})


def property_statistics(events: DataFrame) -> DataFrame:
    """Per event type and numeric property: rows that have it, least, greatest
    and sum of its values."""
    schema = discover(events, "props")
    numeric = [f.name for f in schema.fields if f.dataType.typeName() in ("long", "integer", "double", "decimal", "byte", "short")]
    typed = as_columns(events.select("event_type", "props"), "props", schema, "p_")
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("property"), F.col(f"p_{n}").cast("double").alias("v"))
                                for n in numeric))) if numeric else F.explode(
        F.expr("array()").cast("array<struct<property:string,v:double>>"))
    return (typed.select("event_type", pairs.alias("p")).where("p.v is not null")
            .groupBy("event_type", F.col("p.property").alias("property"))
            .agg(F.count("*").alias("n"), F.min("p.v").alias("low"), F.max("p.v").alias("high"),
                 F.sum("p.v").alias("total")))
