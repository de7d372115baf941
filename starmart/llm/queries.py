"""One query for each operator over its whole table, and the pipeline; with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, collocations, decontamination, html_text, jaccard_join, language_id, packing, pii, prefix_trie, quality_rules, sharding,
    substring_dedup, token_counts,
)
from .oracle import ORACLE  # noqa: F401
from .staging import carry_modules, staged

SHARDS = 24


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    sizes = staged(sharding.keyed_sizes(_table(spark, folder, "documents")), "sizes")
    placed = sharding.shard(sizes, SHARDS, size="size", major="text_hash", minor="doc_id")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    protected = pii.protected_values(docs)
    return pii.digest(pii.all_spans(docs, protected, pii.disclosing_terms(docs, protected)))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), with_ids=False)


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = chat.END + chat.START + "assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, folder, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat.summarize(chat.format_turns(rows.unionByName(more)))


def op7_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, folder, "documents"), with_text=False)


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, folder, "documents"))


def op10_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op11_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"), group=5)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run where Python workers can import this library."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        carry_modules(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f) for f in (
        op1_shards, op2_personal_data, op3_token_counts, op4_quality_rules, op5_packed, op6_chat, op7_benchmark_leaks,
        op8_repeated_passages, op9_near_duplicates, op10_page_text, op11_language, op12_prefix_trie, op13_collocations, pipeline)
}
