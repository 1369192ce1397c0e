"""The contract queries of the training-data operators.

Each query applies its operator with production parameters to the whole
table and derives the contract's columns from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    chat_tree, decontaminate, fill_middle, html_blocks, mixing, oracles, paragraph_dedup, quality_classifier,
    quality_rules, simhash, sketch_dedup, token_files, vector_codes, warc,
)
from ledgerline.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("score")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, name = mixing.place(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return placed.select("doc_id", f"{name}.*")


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.find_repeats(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_digest(token_files.write_tokens(table(spark, sf_dir, "documents")))


def op6_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)],
                                    "conv_id long, turn long, role string, text string")
    return chat_tree.read_digest(chat_tree.pack_conversations(rows.unionByName(control)))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_digest(
        decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.digest(quality_classifier.score(docs, model))


def op11_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.components(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.restore(fill_middle.assemble(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_mixing": op2_mixing,
        "op3_paragraph_dedup": op3_paragraph_dedup,
        "op4_warc": op4_warc,
        "op5_token_files": op5_token_files,
        "op6_chat_tree": op6_chat_tree,
        "op7_simhash": op7_simhash,
        "op8_html_blocks": op8_html_blocks,
        "op9_decontaminate": op9_decontaminate,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_sketch_dedup": op11_sketch_dedup,
        "op12_vector_codes": op12_vector_codes,
        "op13_fill_middle": op13_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
