"""Mergeable monthly aggregates of the facts, from which the feature tables are kept up to date.

Beside the facts two tables hold what the feature tables sum up: by customer and product, and by customer, product,
category and channel, each for every month. After a load only the months whose facts have changed are read again, and only their
part of these tables is written; the feature tables then merge the months.

Which months have changed is not remembered but seen: facts are only ever appended, so a month is up to date if the rows it
has counted are as many as the month holds, a number that Parquet's footers give. A load or refresh that was cut off, or
facts appended by other means, are therefore made up for by the next refresh.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions import dates as D
from starmart.operators.calendar import with_full_date
from starmart.operators.dedup import Parts, grouped_with_distinct, merged, merged_with_distinct
from starmart.plans import churn, cross_sell, customer, performance
from starmart.plans.registry import FEATURE_TABLES, StarTables
from starmart.sources.writers import publish_buckets

MONTH, ROWS = "month", "_rows"


def month_of() -> Column:
    """The month of a fact as a whole number; 0 where the fact has no usable date key."""
    return F.when(F.col("date_month") > 0, F.col("date_month")).otherwise(0)


def facts_of(facts: DataFrame, months: list[int] | None) -> DataFrame:
    """The facts of some months, or all; the folders of other months are not read."""
    if months is None:
        return facts
    dated = F.col("date_month").isin([m for m in months if m > 0])
    return facts.where(dated | F.col("date_month").isNull() | (F.col("date_month") <= 0) if 0 in months else dated)


def customer_product_parts() -> Parts:
    return {
        **customer.customer_parts(), **churn.lifetime_parts(),
        "first_transaction_date": (F.min("full_date"), F.min),
        ROWS: (F.count(F.lit(1)), F.sum),
    }


def spend_parts() -> Parts:
    return {**cross_sell.spend_parts(), ROWS: (F.count(F.lit(1)), F.sum)}


def customer_product_months(facts: DataFrame, dim_date: DataFrame, months: list[int] | None = None) -> DataFrame:
    """The aggregates of each customer, product and month."""
    used = with_full_date(facts_of(facts, months).select(*customer.CUSTOMER_INPUT, month_of().alias(MONTH)), dim_date)
    return used.groupBy("customer_sk", "product_sk", MONTH).agg(*[a.alias(c) for c, (a, _) in customer_product_parts().items()])


def spend_months(facts: DataFrame, dim_date: DataFrame, months: list[int] | None = None) -> DataFrame:
    """The spend of each customer, product, category, channel and month."""
    used = facts_of(facts, months).withColumn(MONTH, month_of())
    return used.groupBy(*cross_sell.SPEND_KEYS, MONTH).agg(*[a.alias(c) for c, (a, _) in spend_parts().items()])


#: Stored table to what works it out.
STATES: dict[str, Callable[..., DataFrame]] = {"month_customer_product": customer_product_months, "month_spend": spend_months}


@dataclass(frozen=True)
class MonthStates:
    customer_product: DataFrame
    spend: DataFrame


def _outdated(facts: DataFrame, stored: DataFrame) -> list[int]:
    """The months whose facts have changed, and those with days that the calendar did not have; one number for each month."""
    held = facts.groupBy(month_of().alias(MONTH)).agg(F.count(F.lit(1)).alias("held"))
    undated = F.sum(F.col(ROWS) - F.col("lifetime_tx_count")) if "lifetime_tx_count" in stored.columns else F.lit(0)
    counted = stored.groupBy(MONTH).agg(F.sum(ROWS).alias("counted"), undated.alias("undated"))
    both = held.join(counted, MONTH, "full_outer")
    return sorted(r[MONTH] for r in both.where("NOT held <=> counted OR undated > 0").select(MONTH).collect())


def refresh(star: StarTables, database: str) -> dict[str, list[int]]:
    """Bring the monthly aggregates of a warehouse up to date and return the months that were read, by table.

    Changed months replace their old aggregates in one catalog operation; until then the old ones stay readable.
    """
    spark, read = star.facts.sparkSession, {}
    for name, build in STATES.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            months = _outdated(star.facts, spark.read.table(table))
            if months:
                publish_buckets(build(star.facts, star.dates, months), table, None, months, place=F.col(MONTH))
        else:
            months = sorted(r[MONTH] for r in star.facts.select(month_of().alias(MONTH)).distinct().collect())
            publish_buckets(build(star.facts, star.dates), table, None, place=F.col(MONTH))
        read[name] = months
    return read


def month_states(star: StarTables, database: str) -> MonthStates:
    return MonthStates(*[star.facts.sparkSession.read.table(f"{database}.{name}") for name in STATES])


def _merges(parts: Parts) -> dict[str, Callable[[str], Column]]:
    return {c: merge for c, (_, merge) in parts.items()}


def customer_features(star: StarTables, states: MonthStates, as_of=None) -> DataFrame:
    parts = _merges(customer.customer_parts())
    return customer.described_customers(
        star.customers, merged_with_distinct(states.customer_product, "customer_sk", "product_sk", "product_count", parts), as_of)


def churn_features(star: StarTables, states: MonthStates, as_of=None) -> DataFrame:
    """Lifetime numbers from the months; of the facts only the months of the longest window are read."""
    lifetime = merged_with_distinct(
        states.customer_product, "customer_sk", "product_sk", "product_count", _merges(churn.lifetime_parts()))
    since = D.date_key(F.date_sub(D.as_of_date(as_of), max(churn.WINDOWS)))
    late = star.facts.where(F.col("date_month") >= F.floor(since / 100).cast("int")).select(*churn.CHURN_INPUT)
    recent = grouped_with_distinct(with_full_date(late, star.dates), "customer_sk", "product_sk", "_products", churn.recent_parts(as_of))
    return churn.described_churn(star.customers, lifetime.join(recent.drop("_products"), "customer_sk", "left"), as_of)


def cross_sell_features(star: StarTables, states: MonthStates, as_of=None) -> DataFrame:
    used = merged(states.spend, list(cross_sell.SPEND_KEYS), _merges(cross_sell.spend_parts()))
    return cross_sell.described_spend(star.customers, used, star.products, as_of, **star.cross_sell_values)


def product_performance(star: StarTables, states: MonthStates, as_of=None) -> DataFrame:
    sold = states.customer_product.withColumnsRenamed({"total_transactions": "transaction_count", "_total": "total_revenue"})
    parts = _merges(performance.product_parts())
    return performance.described_products(
        star.products, merged_with_distinct(sold, "product_sk", "customer_sk", "customer_count", parts), ordered=False)


def regional_analysis(star: StarTables, states: MonthStates, as_of=None) -> DataFrame:
    sums = {"total_transactions": "n", "_total": "amount", "_n": "n_amount", "_balances": "balance", "_balance_n": "n_balance"}
    per_customer = merged(states.customer_product, ["customer_sk"], dict.fromkeys(sums, F.sum)).withColumnsRenamed(sums)
    return performance.regions(per_customer, star.customers, ordered=False)


#: The feature tables that merge the months. Fraud features are a row for each fact and stay with the facts.
FROM_MONTHS: dict[str, Callable[[StarTables, MonthStates, object], DataFrame]] = {
    "vw_customer_features": customer_features,
    "vw_churn_features": churn_features,
    "vw_cross_sell_features": cross_sell_features,
    "vw_product_performance": product_performance,
    "vw_regional_analysis": regional_analysis,
}


def builders(states: MonthStates) -> dict[str, Callable[[StarTables, object], DataFrame]]:
    """The builders of all feature tables, from the months where they can be."""
    def bound(build):
        return lambda star, as_of: build(star, states, as_of)

    return {**FEATURE_TABLES, **{name: bound(build) for name, build in FROM_MONTHS.items()}}
