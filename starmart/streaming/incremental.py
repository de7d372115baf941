"""Incremental load as a stream over folders of arriving files.

Each micro-batch is an ordinary incremental load: customer files first, then transactions. Files are parsed by the batch
reader, so headers count file by file. The key check makes a replayed micro-batch add nothing, so the at-least-once calls
of ``foreachBatch`` give exactly-once facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart.plans.warehouse import Warehouse
from starmart.sources import readers
from starmart.sources.readers import LOAD_ORDER

TRANSACTIONS, CUSTOMERS = "transactions", "customers"


def file_stream(spark: SparkSession, folder: str, kind: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the names of new files: (kind, file), a row for each line."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(folder)
    return lines.select(F.lit(kind).alias("kind"), F.col("_metadata.file_path").alias("file"))


def transaction_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return file_stream(spark, folder, TRANSACTIONS, max_files_per_trigger)


def customer_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return file_stream(spark, folder, CUSTOMERS, max_files_per_trigger)


def load_stream(
    warehouse: Warehouse, transactions: DataFrame, checkpoint: str, customers: DataFrame | None = None
) -> StreamingQuery:
    """Load everything that has arrived, then stop. ``checkpoint`` remembers the files already seen."""
    arriving = transactions if customers is None else transactions.unionByName(customers)

    def load(batch: DataFrame, _batch_id: int) -> None:
        # bounded by maxFilesPerTrigger
        files = batch.distinct().collect()
        spark = warehouse.spark
        changed = sorted(f.file for f in files if f.kind == CUSTOMERS)
        if changed:
            warehouse.load_customers(readers.read_customers(spark, changed, load_order=True), LOAD_ORDER)
        new = sorted(f.file for f in files if f.kind == TRANSACTIONS)
        if new:
            warehouse.load_transactions(readers.read_transactions(spark, new))

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
