"""Written intermediates and block counts."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_path


_carried: set[str] = set()


def carry_modules(spark: SparkSession) -> None:
    """Let the session's Python workers import this library where it is not installed for them.

    The modules are zipped once for an application and handed to Spark, which serves them to every executor.
    """
    application = spark.sparkContext.applicationId
    if application in _carried:
        return
    _carried.add(application)
    package = Path(__file__).resolve().parent.parent
    if package.suffix or not package.is_dir():  # already imported from an archive
        return
    archive = Path(tempfile.mkdtemp(prefix="starmart-modules-")) / "starmart_modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def staged(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Write a table below the cluster's shared folder and read it back: later steps start from the files.

    `row_group` bounds the bytes that a writer holds, for tables of large binary values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def parts(total: int, each: int) -> int:
    """How many parts of about `each` hold `total`."""
    return max(1, math.ceil(total / each))


def block_of(blocks: int, *columns: str) -> Column:
    """A block number from a hash of the columns; rows of one large group of copies spread by their ids."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")
