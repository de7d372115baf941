"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings every starmart job expects. All can be overridden by the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites recorded for every Column make building wide plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app_name: str = "starmart", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the starmart defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates, shared by driver and executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, where one machine
    is the whole cluster, may fall back to a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="starmart-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; never reused between runs."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


#: Whether the shuffle files of an execution go when it ends, in place of when the driver next collects its garbage.
FREE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each write inside removes its shuffle files when it ends: nothing reads them again, and they are most of a load's disk."""
    before = spark.conf.get(FREE_SHUFFLES_CONF, None)
    spark.conf.set(FREE_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES_CONF)
        else:
            spark.conf.set(FREE_SHUFFLES_CONF, before)


def _write_copy(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write rows that several steps read next, so that they are worked out once, and read them back.

    The copy is in the shared scratch folder, hence it survives the loss of executors.
    """
    return _write_copy(df, scratch_path(df.sparkSession, label))


@contextmanager
def staged_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`staged` for steps that end here: the copy is deleted behind them."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _write_copy(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own estimate of the size is within ``spark.sql.autoBroadcastJoinThreshold``."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
