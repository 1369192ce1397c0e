"""The flat retail CSV (S1-S3): header row, 13 columns of which the analytics
use nine (see ``config.CSV_HEADER_TO_MODEL``).

``read_sales_csv`` reads a file *or a directory of part files* in place (the
reference first merged an HDFS directory into one local file). Fields are
read as text and cast, so no inference pass over the data is needed and a
field that does not parse becomes NULL instead of failing the job. Every file
must carry the same header: Spark checks each file's names against the first
one's, so a file with another column order is an error, never a mix-up.
``to_model`` strips header names, turns textual missing markers into NULLs,
renames to snake_case and casts money to DECIMAL straight from the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, StringType, StructField, StructType

from ledgerline.config import CSV_HEADER_TO_MODEL, DEFAULT_NULL_TOKENS, RETAIL, AnalyticsConfig
from ledgerline.operators.cleaning import clean, normalize_nulls, strip_columns
from ledgerline.session import scratch_path
from ledgerline.sources.sinks import write_result

# The columns the analytics need, as they appear in the CSV header.
RETAIL_FIELDS = {
    "Ship Mode": StringType(), "Segment": StringType(), "Region": StringType(),
    "Category": StringType(), "Sub-Category": StringType(), "Sales": DoubleType(),
    "Quantity": IntegerType(), "Discount": DoubleType(), "Profit": DoubleType(),
}


def text_schema(spark: SparkSession, path: str) -> StructType | None:
    """The names of the header line as it is written, all as text. Reading
    one line is a tiny job."""
    first = spark.read.option("header", "false").csv(path).limit(1).collect()
    return StructType([StructField(n or "", StringType(), True) for n in first[0]]) if first else None


def header_schema(spark: SparkSession, path: str) -> StructType:
    """An explicit schema from the header line alone: known columns get their
    types, every other column is a string. No pass over the data is made."""
    found = text_schema(spark, path)
    names = [f.name.strip() for f in found.fields] if found else list(RETAIL_FIELDS)
    return StructType([StructField(n, RETAIL_FIELDS.get(n, StringType()), True) for n in names])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every field as text, columns named by the header (spaces stripped)."""
    found = text_schema(spark, path)
    if found is None:
        return spark.createDataFrame([], StructType(
            [StructField(n, StringType(), True) for n in RETAIL_FIELDS]))
    reader = spark.read.schema(found).option("header", "true").option("mode", "PERMISSIVE")
    return strip_columns(reader.option("enforceSchema", "false").csv(path))


def read_sales_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                   infer: bool = False, null_tokens: tuple[str, ...] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Read the retail CSV (file, glob or directory), typed.

    Types come from ``schema`` (matched by name; a column the files lack is
    NULL) or, without one, from the known retail columns. Missing markers and
    fields that do not parse are NULL. ``infer=True`` reproduces the
    reference's ``inferSchema`` (an extra full pass).
    """
    if infer:
        return strip_columns(spark.read.option("header", "true").option("inferSchema", "true")
                             .option("enforceSchema", "false").csv(path))
    text = normalize_nulls(read_text_csv(spark, path), null_tokens)
    wanted = schema.fields if schema else [
        StructField(n, RETAIL_FIELDS.get(n, StringType()), True) for n in text.columns]
    return text.select(*[
        (_cast(F.col(f"`{f.name}`"), f.dataType.simpleString()) if f.name in text.columns
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])


def _cast(c: Column, kind: str) -> Column:
    """Text to ``kind``, NULL where it does not parse; whole numbers may be
    written with decimals."""
    if kind in ("int", "bigint", "smallint", "tinyint"):
        return F.trim(c).try_cast("decimal(38,10)").try_cast(kind)
    return c if kind == "string" else F.trim(c).try_cast(kind)


MODEL_TYPES = {"quantity": "int", "discount": "double", "sales": "decimal(18,4)", "profit": "decimal(18,4)"}


def to_model(df: DataFrame, null_tokens: tuple[str, ...] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Raw CSV frame (text or typed) -> model columns (region, segment,
    category, sub_category, ship_mode, quantity, discount, sales, profit) plus
    any extra columns.

    Textual missing markers and values out of range become NULL (T3), NaN in a
    measure too. Money is DECIMAL(18,4) so sums are exact; from text it is cast
    without a detour through DOUBLE.
    """
    df = normalize_nulls(strip_columns(df), null_tokens)
    cols = []
    for name in df.columns:
        target = CSV_HEADER_TO_MODEL.get(name)
        c = F.col(f"`{name}`")
        if target in MODEL_TYPES:
            kind = MODEL_TYPES[target]
            if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
                c = F.when(F.isnan(c), F.lit(None)).otherwise(c).try_cast(kind)
            elif isinstance(df.schema[name].dataType, StringType):
                value = _cast(c, kind)
                c = F.when(F.isnan(value), F.lit(None)).otherwise(value) if kind == "double" else value
            else:
                c = c.try_cast(kind)
        cols.append(c.alias(target or name))
    return df.select(*cols)


def load_retail_fact(spark: SparkSession, path: str, do_clean: bool = True,
                     subset: list[str] | None = None, cfg: AnalyticsConfig = RETAIL) -> DataFrame:
    """Read -> normalise -> (clean) in one call; the flat-CSV counterpart of
    ``sources.star.bind_fact``."""
    fact = to_model(read_text_csv(spark, path), cfg.null_tokens)
    return clean(fact, subset=subset) if do_clean else fact


def csv_round_trip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write a small result as CSV and read it back, typed as it was."""
    path = write_result(df, scratch_path(spark, "csv-result"), single_file=True)
    return read_sales_csv(spark, path, df.schema)


def write_retail_csv(fact: DataFrame, path: str, null_token: str = "NA") -> str:
    """The fact as a directory of CSV part files under the retail header, one
    per task, nulls as ``null_token``."""
    names = {model: header for header, model in CSV_HEADER_TO_MODEL.items()}
    rows = fact.select(*(F.col(c).alias(names[c]) for c in fact.columns if c in names))
    rows.write.mode("overwrite").option("header", "true").option("nullValue", null_token).csv(path)
    return path


def reload_fact(spark: SparkSession, fact: DataFrame, cfg: AnalyticsConfig = RETAIL) -> DataFrame:
    """The whole fact through files: written as part files, then read,
    normalised and cleaned as a landed load is."""
    return load_retail_fact(spark, write_retail_csv(fact, scratch_path(spark, "csv-fact")), cfg=cfg)


def through_csv(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write a result of any size as CSV part files and read it back, typed."""
    path = write_result(df, scratch_path(spark, "csv-result"))
    return read_sales_csv(spark, path, df.schema)
