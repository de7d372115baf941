"""Sinks: appends, versioned replacement, exports and views."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.session import delete_folder, shuffles_freed
from starmart.sources.readers import CSV_DIALECT

log = logging.getLogger(__name__)

#: Tail of a written version: number, and a tag that no other run shares.
_VERSION = re.compile("__v([0-9]+)_[0-9a-f]{8}$")


def append_table(df: DataFrame, table: str, cluster_by: tuple[str, ...] = ()) -> None:
    """Append rows by column name.

    ``cluster_by`` rebalances on those columns first: each partition folder gets few, evenly sized files, and
    adaptive execution splits a folder that holds most of the rows.
    """
    target = df.sparkSession.read.table(table)
    out = df.select(*target.columns)
    if cluster_by:
        out = out.hint("rebalance", *cluster_by)
    with shuffles_freed(df.sparkSession):
        out.write.mode("append").insertInto(table)


def _split(name: str) -> tuple[str | None, str]:
    database, _, table = name.rpartition(".")
    return database or None, table


def _version_of(table: str) -> int | None:
    found = _VERSION.search(table)
    return int(found.group(1)) if found else None


def _written_tables(spark: SparkSession, name: str) -> dict[str, int]:
    """Tables written for a published name, with their version numbers."""
    database, table = _split(name)
    prefix = f"{database}." if database else ""
    found = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{table}__v*'").collect()
    names = [row.tableName for row in found if _VERSION.sub("", row.tableName) == table]
    return {prefix + n: _version_of(n) for n in names}


def table_versions(spark: SparkSession, name: str) -> list[int]:
    """Versions of a published table that are still stored, oldest first."""
    return sorted(_written_tables(spark, name).values())


def publish(df: DataFrame, name: str, skip_empty: bool = False, keep: int = 2) -> bool:
    """Replace ``name`` with the rows of ``df``, which may itself read ``name``.

    The rows go to a new table and ``name`` is a view that is then switched to it in one catalog operation. A run that
    fails midway leaves the previous contents readable; what it wrote is dropped by a later run. The last ``keep``
    versions stay for readers that started before the switch. With ``skip_empty`` an empty result leaves the previous
    contents in place. A name has one writer at a time: two at once may drop each other's tables. Returns whether
    ``name`` changed.
    """
    spark = df.sparkSession
    version = (_live_version(spark, name) or 0) + 1
    target = f"{name}__v{version}_{uuid.uuid4().hex[:8]}"
    with shuffles_freed(spark):
        df.write.saveAsTable(target, format="parquet", mode="errorifexists")
    if skip_empty and spark.read.table(target).isEmpty():
        spark.sql(f"DROP TABLE {target}")
        log.warning("%s not replaced: the new result is empty", name)
        return False
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {target}")
    for table, old in _written_tables(spark, name).items():
        if old <= version - keep or (old == version and table != target):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return True


def _live_version(spark: SparkSession, name: str) -> int | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    version = _version_of(rows[0].data_type.strip().rstrip("`")) if rows else None
    if version is None:
        raise ValueError(f"{name} exists and is not a published view")
    return version


#: Partition columns of a table that is published by bucket, and the property that holds its number of buckets.
BUCKET, WRITTEN, BUCKETS = "_bucket", "_written", "starmart.buckets"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _live_table(spark: SparkSession, name: str) -> str:
    """The table that a published view reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[0].data_type.split(" FROM ")[-1].strip()


def _pieces(spark: SparkSession, table: str) -> dict[int, str]:
    """For each stored bucket of a version the version that wrote it."""
    found = (dict(part.split("=", 1) for part in row.partition.split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return {int(p[BUCKET]): p[WRITTEN] for p in found}


def _folder(spark: SparkSession, name: str, tag: str) -> str:
    database, table = _split(name)
    database = database or spark.catalog.currentDatabase()
    place = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first().info_value
    return f"{place.rstrip('/')}/{table}__{tag}"


def read_buckets(spark: SparkSession, name: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of some buckets of a table published by bucket, or of all; other buckets are not read."""
    rows = spark.read.table(_live_table(spark, name))
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(buckets) if buckets else F.lit(False))
    return rows.drop(BUCKET, WRITTEN)


def bucket_count(spark: SparkSession, name: str) -> int:
    found = spark.sql(f"SHOW TBLPROPERTIES {_live_table(spark, name)}").where(F.col("key") == BUCKETS).first()
    return int(found.value)


def publish_buckets(
    rows: DataFrame, name: str, key: str | None, changed: list[int] | None = None, buckets: int = 64, keep: int = 2, place: Column | None = None,
) -> None:
    """Replace the ``changed`` buckets of ``name`` with ``rows``, which hold all rows of these buckets and may read ``name``.

    ``name`` is a view of a table whose partitions are buckets of the hash of ``key``. A new version writes the changed
    buckets only and refers to the older versions' files for all others; then the view is switched to it in one catalog
    operation, so a run that fails midway leaves the previous contents readable. Without ``changed`` everything is replaced;
    a bucket that is changed and has no rows becomes empty. The last ``keep`` versions stay readable, files that none of
    them refers to are deleted. The first call fixes the number of buckets. With ``place``, a whole number of few values such as a month, that
    is the bucket in place of the hash. A name has one writer at a time.
    """
    spark = rows.sparkSession
    live = _live_version(spark, name)
    kept = {} if live is None or changed is None else {b: t for b, t in _pieces(spark, _live_table(spark, name)).items() if b not in set(changed)}
    if live is not None:
        buckets = bucket_count(spark, name)
    tag = f"v{(live or 0) + 1}_{uuid.uuid4().hex[:8]}"
    target = f"{name}__{tag}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"""CREATE TABLE {target} ({columns}, {BUCKET} INT, {WRITTEN} STRING) USING parquet PARTITIONED BY ({BUCKET}, {WRITTEN})
        LOCATION '{_folder(spark, name, tag)}' TBLPROPERTIES ('{BUCKETS}' = '{buckets}')""")
    placed = rows.withColumns({BUCKET: bucket_of(key, buckets) if place is None else place.cast("int"), WRITTEN: F.lit(tag)})
    with shuffles_freed(spark):
        placed.hint("rebalance", BUCKET).write.mode("append").insertInto(target)
    if kept:
        places = " ".join(
            f"PARTITION ({BUCKET} = {b}, {WRITTEN} = '{t}') LOCATION '{_folder(spark, name, t)}/{BUCKET}={b}/{WRITTEN}={t}'" for b, t in sorted(kept.items()))
        spark.sql(f"ALTER TABLE {target} ADD {places}")
    shown = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {target}")
    _drop_unused(spark, name, target, keep)


def _drop_unused(spark: SparkSession, name: str, live: str, keep: int) -> None:
    """Drop versions that are no longer kept, and the files that no kept version refers to."""
    versions = _written_tables(spark, name)
    newest = _version_of(live)
    gone = [t for t, v in versions.items() if v <= newest - keep or (v == newest and t != live)]
    if not gone:
        return
    used = {piece for t in versions if t not in gone for piece in _pieces(spark, t).items()}
    for table in gone:
        for bucket, tag in set(_pieces(spark, table).items()) - used:
            delete_folder(spark, f"{_folder(spark, name, tag)}/{BUCKET}={bucket}/{WRITTEN}={tag}")
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view and return a scan of it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.read.table(name)


def view_statement(name: str, query: str) -> str:
    """SQL text that creates or replaces a stored view."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    return f"CREATE OR REPLACE VIEW {quoted} AS {query}"


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write CSV that :func:`starmart.sources.readers.read_csv` reads back, blanks, quotes and line ends included."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**CSV_DIALECT, compression=compression).csv(path)


def export_csv(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]], folder: str, compression: str = "gzip"
) -> dict[str, str | None]:
    """Write each table as CSV under ``folder``; a table that fails is logged and the rest go on.

    Files are compressed, as the product pairs repeat their names in every row; readers of CSV open them as they are. Returns the error text per table, ``None`` where the export worked.
    """
    outcome: dict[str, str | None] = {}
    for name, source in tables.items():
        try:
            write_csv(source() if callable(source) else source, f"{folder}/{name}", compression)
            outcome[name] = None
        except Exception as error:  # one bad table must not stop the others
            log.warning("could not export %s: %s", name, error)
            outcome[name] = str(error)
    return outcome
