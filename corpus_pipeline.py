"""From raw documents to packed training sequences: five stages, each calling one operator of ``levyline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and hands it, reread, to the next. All stages but the last return the columns of ``docs``.

Defined results: rows with a null id pass the document filters unless their own text is rejected; of rows that
repeat an id one stays at near-dedup; empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.llm.common import scratch, table
from levyline.llm.context_pii import find, redact
from levyline.llm.crossparse import in_known_language
from levyline.llm.harmonic_pack import pack
from levyline.llm.lsh_forest import near_duplicates
from levyline.llm.template_decontam import leaks


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which the cross-parser finds text of a learned language; those without a letter go."""
    return in_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8): the one with the smallest id."""
    found = near_duplicates(docs, k=5, percent=80)
    kept = found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")).withColumnRenamed("doc_id", "kept_id")
    rows = docs.join(kept.select("kept_id"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    if kept.where("copies > 1 AND kept_id IS NOT NULL").isEmpty():
        return rows
    return rows.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(rows.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    leaked = leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col("leaked_id")), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in angle brackets; ``n_chars`` follows the text."""
    spans = find(docs).where(F.size("spans") > 0).select(F.col("doc_id").alias("span_id"), "text_key", "spans").dropDuplicates(["span_id", "text_key"])
    same = F.col("d.doc_id").eqNullSafe(F.col("s.span_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("s.text_key"))
    rows = docs.alias("d").join(spans.alias("s"), same, "left")
    text = F.when(F.col("s.spans").isNotNull(), redact(F.col("d.text"), F.col("s.spans"))).otherwise(F.col("d.text"))
    rows = rows.select(*(text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of at most 4096."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("packing", packing),
]
#: SQL cannot express the trained language model, the tokenizer or the pattern bootstrapping.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
