"""Slowly changing dimension, type 2, as set operations over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starmart.contracts import CUSTOMER_ATTRIBUTES, DIM_CUSTOMER
from starmart.functions.columns import any_of, differs
from starmart.functions.dates import as_of_date
from starmart.operators.dedup import keep_last
from starmart.operators.keys import assign_surrogate_keys

ID = "customer_id"


def compare_to_current(
    incoming: DataFrame, dim: DataFrame, tracked: Sequence[str] = tuple(CUSTOMER_ATTRIBUTES)
) -> DataFrame:
    """Incoming customers with ``old_version`` (NULL for a new customer) and ``is_changed``.

    Comparison is null-safe on the declared types. A customer is looked up among current rows only.
    """
    old = dim.where("is_current").select(
        ID, F.col("version").alias("old_version"), F.struct(*tracked).alias("_old")
    )
    joined = incoming.join(old, ID, "left")
    changed = any_of(differs(F.col(c), F.col(f"_old.{c}")) for c in tracked)
    return joined.withColumn("is_changed", F.col("old_version").isNotNull() & changed).drop("_old")


def detect_changes(
    raw: DataFrame,
    dim: DataFrame,
    as_of=None,
    tracked: Sequence[str] = tuple(CUSTOMER_ATTRIBUTES),
    order: str | list[str] | None = None,
    effective_offset_days: int = 0,
) -> DataFrame:
    """New customers (version 1) and changed ones (version + 1); unchanged customers are left out.

    ``order`` names the column that decides which copy of a customer is the last one; without it the input must
    hold one row per customer. An empty ``tracked`` list detects nothing. Attributes the input does not carry are
    taken as unchanged from the current row when they are not tracked.
    """
    last = keep_last(raw, ID, order) if order else raw
    if not tracked:
        return _new_versions(last.where(F.lit(False)).withColumn("version", F.lit(1)), as_of, effective_offset_days)
    incoming = _with_attributes(last, dim)
    compared = compare_to_current(incoming, dim, tracked)
    fresh = compared.where(F.col("old_version").isNull() | F.col("is_changed"))
    version = (F.coalesce("old_version", F.lit(0)) + 1).cast("int")
    return _new_versions(fresh.withColumn("version", version), as_of, effective_offset_days)


def _with_attributes(incoming: DataFrame, dim: DataFrame) -> DataFrame:
    """Bring the descriptive columns to their declared types, absent ones filled from the current row."""
    absent = [c for c in CUSTOMER_ATTRIBUTES if c not in incoming.columns]
    typed = incoming.select(
        F.col(ID).cast("string").alias(ID),
        *[F.col(c).try_cast(t).alias(c) for c, t in CUSTOMER_ATTRIBUTES.items() if c not in absent],
    )
    if not absent:
        return typed
    return typed.join(dim.where("is_current").select(ID, *absent), ID, "left")


def _new_versions(rows: DataFrame, as_of, offset_days: int) -> DataFrame:
    present = [c for c in CUSTOMER_ATTRIBUTES if c in rows.columns]
    return rows.select(
        ID,
        *present,
        F.date_add(as_of_date(as_of), offset_days).alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
        F.col("version"),
    )


def apply_changes(dim: DataFrame, changes: DataFrame, as_of=None, keyed: DataFrame | None = None) -> DataFrame:
    """The whole dimension after a batch: history, unchanged current rows, expired rows, new versions.

    The replaced rows expire on the as-of day. History passes through without a shuffle; only current rows meet the
    batch, and they keep their keys. New versions continue after the largest key of ``keyed``, which is ``dim`` unless
    ``dim`` is only the part that holds the batch's customers. Both inputs are read more than once: store them first when
    they are expensive, and store the result before the next batch.
    """
    replaced = changes.where("version > 1").select(ID, F.lit(True).alias("_replaced"))
    history = dim.where("NOT is_current")
    hit = F.col("_replaced").isNotNull()
    current = (
        dim.where("is_current").join(replaced, ID, "left")
        .withColumns({
            "expiry_date": F.when(hit, as_of_date(as_of)).otherwise(F.col("expiry_date")),
            "is_current": ~hit,
        })
        .drop("_replaced")
    )
    added = DIM_CUSTOMER.conform(assign_surrogate_keys(changes, "customer_sk", existing=dim if keyed is None else keyed))
    return current.select(dim.columns).unionByName(history).unionByName(added.select(dim.columns))


def initial_versions(customers: DataFrame, as_of=None) -> DataFrame:
    """First load: every customer is current, effective on the as-of day, version 1."""
    stamped = customers.withColumns({
        "effective_date": as_of_date(as_of),
        "expiry_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "version": F.lit(1),
    })
    return DIM_CUSTOMER.conform(stamped)


def history_violations(dim: DataFrame) -> DataFrame:
    """Customers that break the invariants: other than one current row, or a gap in the versions."""
    return (
        dim.groupBy(ID)
        .agg(
            F.count_if("is_current").alias("current_rows"),
            F.count(F.lit(1)).alias("rows"),
            F.min("version").alias("first_version"),
            F.max("version").alias("last_version"),
        )
        .where("current_rows <> 1 OR first_version <> 1 OR last_version <> rows")
    )
