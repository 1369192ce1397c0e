"""The training-corpus pipeline: quality classifier, near-duplicates,
benchmark decontamination, mixing and token files over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all the rows it is
given. All but the last return the columns of ``documents``:

* ``quality_classifier`` learns from ``labels`` and the texts of ``docs`` and
  drops the documents it rejects;
* ``simhash_near_dedup`` keeps one document of each near-duplicate group;
* ``benchmark_decontamination`` drops the documents that hold a window of a
  ``benchmark`` item;
* ``mixing`` keeps all documents and writes them in the order of the Pfair
  schedule over their sources;
* ``token_files`` encodes them in the order in which its input is stored and
  returns where each document's ids lie.

Nulls, empty texts, repeated rows and empty tables go through as the operators
define them (see ``ledgerline/llm``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.llm import decontaminate, mixing, quality_classifier, simhash, token_files
from ledgerline.llm.common import drop_stored, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accept(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def _stored_order(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the order of its files and of the rows in them, which is
    the order it was written in; rows that come from no file go by id."""
    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("_file"),
                           F.col("_metadata.row_index").alias("_row"))
        part = F.expr("try_cast(regexp_extract(_file, 'part-([0-9]+)', 1) AS bigint)")
        return rows, [part, F.col("_file"), F.col("_row")]
    except AnalysisException:
        return docs.select("doc_id", "text"), [F.col("doc_id")]


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ordered, order = _stored_order(docs)
    return token_files.read_digest(token_files.write_tokens(ordered, order=order))


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: The first two stages train a network and hash shingles; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table; every
    stage's output is written as parquet and read again for the next one."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
            if before is not None:
                drop_stored(before)
            before = docs
    return docs
