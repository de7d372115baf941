"""Fact preparation: required fields, valid dates, key lookup, insert-if-absent."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from starmart.contracts import FACT_TRANSACTIONS
from starmart.functions import dates as D
from starmart.functions.columns import any_of
from starmart.operators import ordered
from starmart.operators.dedup import keep_last
from starmart.session import broadcastable

#: A transaction without one of these is not loaded.
REQUIRED = ("transaction_id", "customer_id", "product_id", "amount", "transaction_date")


class DropCounts:
    """Row counts taken while the facts are written, at no extra pass over the data.

    Where the planner finds that no fact can be left, as with an empty dimension, it may not run the watched rows at all;
    they are then counted by themselves.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, DataFrame, list[Column]]] = []

    def _watch(self, rows: DataFrame, *counts: Column) -> DataFrame:
        observation = Observation()
        self._watched.append((observation, rows, list(counts)))
        return rows.observe(observation, *counts)

    def watch_cleaning(self, flagged: DataFrame) -> DataFrame:
        return self._watch(
            flagged,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if("_incomplete").alias("null_required"),
            F.count_if(~F.col("_incomplete") & ~F.col("_date_ok")).alias("invalid_date"),
        )

    def watch_lookup(self, looked_up: DataFrame) -> DataFrame:
        no_customer, no_product = F.col("customer_sk").isNull(), F.col("product_sk").isNull()
        return self._watch(
            looked_up,
            F.count_if(no_customer).alias("missing_customer"),
            F.count_if(no_product).alias("missing_product"),
            F.count_if(~no_customer & ~no_product).alias("rows_out"),
        )

    def get(self) -> dict[str, int]:
        """Blocks until an action has run over the watched facts."""
        out: dict[str, int] = {}
        for observation, rows, counts in self._watched:
            try:
                out |= observation.get
            except Py4JJavaError:  # the rows were not run
                out |= rows.agg(*counts).first().asDict()
        return out


def with_date_key(transactions: DataFrame) -> DataFrame:
    """``transaction_date`` as a date and its key; both NULL when the date is unknown."""
    day = F.to_date("transaction_date")
    return transactions.withColumns({"transaction_date": day, "date_key": D.date_key(day)})


def complete_rows(transactions: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    return transactions.na.drop(subset=list(required))


def valid_date_key(key: Column) -> Column:
    return key.between(D.MIN_DATE_KEY, D.MAX_DATE_KEY)


def valid_dates(transactions: DataFrame) -> DataFrame:
    return transactions.where(valid_date_key(F.col("date_key")))


def current_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.where("is_current")


def bind_as_of(transactions: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Add the key of the customer version that was valid on the day of each transaction.

    A version is valid from its effective date to the next one's; the first version of a customer has always been valid. A
    transaction without a day or of an unknown customer gets NULL. See :func:`starmart.operators.ordered.as_of`.
    """
    since = F.when(F.col("version") == 1, F.lit("0001-01-01").cast("date")).otherwise(F.col("effective_date"))
    versions = dim_customer.select("customer_id", since.alias("_since"), F.col("version").alias("_bound_version"), "customer_sk")
    dated = transactions.withColumn("_day", F.to_date("transaction_date"))
    return ordered.as_of(dated, versions, "customer_id", "_day", "_since", ["_bound_version", "customer_sk"]).drop("_day", "_bound_version")


def lookup_keys(
    transactions: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_branch: DataFrame | None = None,
    as_of_date: bool = False,
) -> DataFrame:
    """Left joins to the current dimension rows; a miss leaves the surrogate key NULL.

    No broadcast is forced. Spark broadcasts a dimension below ``spark.sql.autoBroadcastJoinThreshold`` and sorts
    and merges a larger one, where adaptive execution splits the partitions of a hot key. With ``as_of_date`` a customer's
    version of the transaction's day is taken in place of the current one.
    """
    if as_of_date:
        bound = bind_as_of(transactions, dim_customer)
    else:
        bound = transactions.join(current_customers(dim_customer).select("customer_id", "customer_sk"), "customer_id", "left")
    out = bound.join(dim_product.select("product_id", "product_sk"), "product_id", "left")
    if dim_branch is not None:
        out = out.join(dim_branch.select("branch_id", "branch_sk"), "branch_id", "left")
    return out


def lookup_keys_strict(
    transactions: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, counts: DropCounts | None = None,
    as_of_date: bool = False,
) -> DataFrame:
    """Lookup of customer and product; rows that miss either are dropped (and counted)."""
    looked_up = lookup_keys(transactions, dim_customer, dim_product, as_of_date=as_of_date)
    if counts:
        looked_up = counts.watch_lookup(looked_up)
    return looked_up.where("customer_sk IS NOT NULL AND product_sk IS NOT NULL")


def transform_transactions(
    raw: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, counts: DropCounts | None = None,
    as_of_date: bool = False,
) -> DataFrame:
    """Raw transactions to facts: date key, required fields, valid dates, strict key lookup.

    Incomplete rows go before the joins, so that NULL keys never meet in one shuffle partition.
    """
    dated = with_date_key(raw)
    if counts:
        dated = counts.watch_cleaning(
            dated.withColumns({
                "_incomplete": any_of(F.col(c).isNull() for c in REQUIRED),
                "_date_ok": F.coalesce(valid_date_key(F.col("date_key")), F.lit(False)),
            })
        ).drop("_incomplete", "_date_ok")
    return lookup_keys_strict(valid_dates(complete_rows(dated)), dim_customer, dim_product, counts, as_of_date)


def known_keys(batch: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """The stored keys that the batch holds too."""
    return stored.select(*on).join(batch.select(*on), on, "left_semi")


def absent_rows(
    batch: DataFrame, stored: DataFrame, key: str, dedup_batch: bool = False, fixed_columns: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet.

    A batch small enough for Spark to broadcast first cuts the stored side to its keys with a semi join: it filters the
    stored keys in their scan, and the large table is never shuffled. A larger batch meets the stored keys as they are, since
    to cut them would work out and shuffle its keys a second time and save nothing. Copies of one key inside the batch all
    pass unless ``dedup_batch`` is set. A NULL key never counts as stored.

    ``fixed_columns`` names columns that always have the same value for a key, such as the month of a transaction.
    They join the key, and where the stored table is partitioned by them only the batch's partitions are read.
    """
    on = [key, *fixed_columns]
    known = known_keys(batch, stored, on) if broadcastable(batch.select(*on)) else stored.select(*on)
    fresh = batch.join(known, on, "left_anti")
    if not dedup_batch:
        return fresh
    # which copy stays depends on its values alone, so a retry keeps the same one
    values = [c for c in fresh.columns if c != key]
    return keep_last(fresh.withColumn("_copy", F.xxhash64(*values)), key, "_copy").drop("_copy") if values else fresh.distinct()


def fact_columns(facts: DataFrame) -> DataFrame:
    """Only the fact-table columns that are present."""
    return facts.select(*[c for c in FACT_TRANSACTIONS.columns if c in facts.columns])
