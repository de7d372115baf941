"""A corpus pipeline of five stages over `documents`, each calling an operator of `starmart.llm`.

A stage takes (spark, docs, folder) and returns a table that is written before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontamination, jaccard_join, packing, pii, quality_rules
from starmart.llm.staging import carry_modules, staged


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base checks and the certified rules."""
    return quality_rules.quality_filter(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked rows one, that of smallest id, NULL last.

    Rows are told apart by their place, so repeated rows, rows without an id and different texts that share one are rows of
    their own; of those with one id the first one written stays. Rows without words link with nothing and stay.
    """
    carry_modules(spark)
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "placed")
    found = jaccard_join.jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    named = staged(found, "components").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    kept = named.groupBy("component_id").agg(first).select(F.col("first._row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    carry_modules(spark)
    return decontamination.without_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mask(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data masked; n_chars follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents' tokens in windows of 4096."""
    carry_modules(spark)
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate),
    ("personal data", mask), ("packing", pack),
]
#: Binomial tests, tokens and components are beyond SQL on whole tables; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "".join(c if c.isalnum() else "-" for c in name))
    return docs
