"""Per-key operations in row order, as a prefix scan: a key's rows never have to lie in one task.

The rows are range-partitioned by (key, order) and written; each partition is a run of the global order. Windows work
inside (run, key). What a run has to know of the runs before it is carried by a summary of one row per (run, key): a key
that continues from the run before is the first one of its run, so at most one carry row per run is joined back. Rows
without a time, or any number of rows of one time, are cut like all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.session import staged

RUN = "_run"
_CARRY, _KEY, _AT = "_carry", "_carry_key", "_carry_run"


def in_runs(df: DataFrame, key: str, order: Sequence[str], runs: int | None = None) -> DataFrame:
    """The rows with their run of the order (key, ``order``), NULL last; written, so that every reader sees the same runs.

    ``runs`` defaults to the session's shuffle partitions, fewer where adaptive execution finds little data.
    """
    by = [F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_last() for c in order]]
    placed = df.repartitionByRange(runs, *by) if runs else df.repartitionByRange(*by)
    return staged(placed.withColumn(RUN, F.spark_partition_id()), "runs")


def inside(key: str, order: Sequence[str]):
    """The rows of a key inside one run, in order."""
    return Window.partitionBy(RUN, key).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _up_to_here(key: str, order: Sequence[str]):
    return inside(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_carry(rows: DataFrame, key: str, summary: Column, carry) -> DataFrame:
    """Add what ``carry`` makes of the summaries of the key's earlier runs; NULL in the key's first run."""
    runs = Window.partitionBy(key).orderBy(RUN)
    continued = (
        rows.groupBy(key, RUN).agg(summary.alias("_summary"))
        .select(F.col(key).alias(_KEY), F.col(RUN).alias(_AT), carry(F.col("_summary"), runs).alias(_CARRY), F.row_number().over(runs).alias("_nth"))
        .where("_nth > 1").drop("_nth")
    )
    # at most one row per run
    met = rows.join(F.broadcast(continued), F.col(key).eqNullSafe(F.col(_KEY)) & (F.col(RUN) == F.col(_AT)), "left")
    return met.drop(_KEY, _AT)


def _before(runs):
    return runs.rowsBetween(Window.unboundedPreceding, -1)


def with_previous(df: DataFrame, key: str, time: str, tie_break: str, name: str, runs: int | None = None) -> DataFrame:
    """Add the previous ``time`` of the same key, in (time, tie_break) order; NULL for the first row.

    Rows without a time come last, and the row after one of them has no previous time.
    """
    order = [time, tie_break]
    last = F.when(F.count_if(F.col(time).isNull()) == 0, F.max(time))
    rows = _with_carry(in_runs(df, key, order, runs), key, last, lambda s, over: F.lag(s).over(over))
    window = inside(key, order)
    value = F.when(F.row_number().over(window) == 1, F.col(_CARRY)).otherwise(F.lag(time).over(window))
    return rows.withColumn(name, value).select(*df.columns, name)


def with_running_sum(
    df: DataFrame, key: str, time: str, tie_break: str, value: Column, name: str, runs: int | None = None
) -> DataFrame:
    """Add the running total of ``value`` per key in (time, tie_break) order, the current row included.

    Give ``value`` as a decimal: the total is then exact wherever the runs are cut. NULL adds nothing; while a key has
    had no value its total is NULL.
    """
    order = [time, tie_break]
    rows = in_runs(df.withColumn("_value", value), key, order, runs)
    carried = _with_carry(rows, key, F.sum("_value"), lambda s, over: F.sum(s).over(_before(over)))
    here = F.sum("_value").over(_up_to_here(key, order))
    total = F.coalesce(F.col(_CARRY) + here, here, F.col(_CARRY))
    return carried.withColumn(name, total).select(*df.columns, name)


def with_position(df: DataFrame, key: str, order: Sequence[str], name: str, runs: int | None = None) -> DataFrame:
    """Add the number of the key's rows before each row, in ``order``; the order must tell any two rows apart or they are equal."""
    rows = in_runs(df, key, order, runs)
    carried = _with_carry(rows, key, F.count(F.lit(1)), lambda s, over: F.sum(s).over(_before(over)))
    at = F.coalesce(F.col(_CARRY), F.lit(0)) + F.row_number().over(inside(key, order)) - 1
    return carried.withColumn(name, at.cast("long")).select(*df.columns, name)


def as_of(
    events: DataFrame, versions: DataFrame, key: str, time: str, since: str, values: Sequence[str], runs: int | None = None
) -> DataFrame:
    """Each event with ``values`` of the key's last version whose ``since`` is not after the event's ``time``.

    Events and versions are merged into one ordered scan: no join, and neither side of a hot key is gathered. An event
    before the first version, or without a time or a key, has NULL values. Of versions with one ``since`` the last by its
    values counts.
    """
    version = F.struct(*values)
    kinds = events.withColumns({"_at": F.col(time), "_rank": F.lit(1), "_version": F.lit(None).cast(versions.select(version).schema[0].dataType)})
    known = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        key, F.col(since).cast(events.schema[time].dataType).alias("_at"), F.lit(0).alias("_rank"), version.alias("_version"))
    order = ["_at", "_rank", "_version"]
    rows = in_runs(kinds.unionByName(known, allowMissingColumns=True), key, order, runs)
    newest = F.last("_version", ignorenulls=True)
    # in order, a run's last version is its largest (since, values)
    summary = F.max(F.when(F.col("_version").isNotNull(), F.struct("_at", "_version")))["_version"]
    carried = _with_carry(rows, key, summary, lambda s, over: F.last(s, ignorenulls=True).over(_before(over)))
    bound = F.coalesce(newest.over(_up_to_here(key, order)), F.col(_CARRY))
    found = F.when(F.col("_at").isNotNull() & F.col(key).isNotNull(), bound)
    out = carried.withColumn("_found", found).where("_rank = 1")
    return out.select(*events.columns, *[F.col(f"_found.`{v}`").alias(v) for v in values])
