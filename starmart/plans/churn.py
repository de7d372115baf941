"""Churn risk and churn features.

Facts are aggregated per customer before they meet the dimension. The aggregate is combined on the map side, so a
customer with a third of all transactions costs one row per map task, and the join is between customer-sized tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from starmart.functions import dates as D
from starmart.functions.columns import mean_of, relative_change, with_numbers_or_zero
from starmart.operators.calendar import with_full_date
from starmart.operators.dedup import Parts, grouped_with_distinct
from starmart.operators.facts import current_customers

# --- fixed values: default thresholds ---------------------------------------------------------------------
INACTIVE_DAYS = 60
WINDOWS = (30, 60, 90)
# ----------------------------------------------------------------------------------------------------------


def lookback_counts(day: Column, as_of, windows: Sequence[int] = WINDOWS, prefix: str = "txn_last_") -> list[Column]:
    """One count per window of the rows dated at most that many days before the as-of day."""
    today = D.as_of_date(as_of)
    return [F.count_if(day >= F.date_sub(today, w)).alias(f"{prefix}{w}d") for w in windows]


def churn_status(days_since: Column, inactive_days: float = INACTIVE_DAYS) -> Column:
    """Status from fractional days; a customer without any transaction counts as active."""
    return (
        F.when(days_since > F.lit(float(inactive_days)), "Churned")
        .when(days_since > F.lit(inactive_days * 0.5), "At Risk")
        .otherwise("Active")
    )


def churn_risk(
    dim_customer: DataFrame,
    facts: DataFrame,
    dim_date: DataFrame,
    as_of=None,
    inactive_days: float = INACTIVE_DAYS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Churn status of every current customer, with or without transactions."""
    per_customer = (
        with_full_date(facts.select("customer_sk", "date_key"), dim_date)
        .groupBy("customer_sk")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.max("full_date").alias("last_transaction_date"),
            *lookback_counts(F.col("full_date"), as_of, windows),
        )
    )
    counts = ["total_transactions", *[f"txn_last_{w}d" for w in windows]]
    days = D.elapsed_days(F.col("last_transaction_date"), D.as_of_timestamp(as_of))
    return (
        current_customers(dim_customer).select("customer_sk", "customer_id", "customer_name", "customer_segment")
        .join(per_customer, "customer_sk", "left")
        .na.fill(0, counts)
        .select(
            "customer_sk", "customer_id", "customer_name", "customer_segment",
            "total_transactions", "last_transaction_date",
            days.cast("int").alias("days_since_last_txn"),
            *counts[1:],
            churn_status(days, inactive_days).alias("churn_status"),
        )
    )


def period_sums(day: Column, as_of) -> dict[str, Column]:
    """Sums and counts of the last 30 days and of the 30 days before, as conditional aggregates that can be added up."""
    today = D.as_of_date(as_of)
    recent = day >= F.date_sub(today, 30)
    prior = (day >= F.date_sub(today, 60)) & (day < F.date_sub(today, 30))
    return {
        f"_{what}_{name}": F.count(picked) if counted else F.sum(picked)
        for name, condition in (("last", recent), ("prev", prior))
        for what, column, counted in (("amount", "amount", False), ("balance", "balance_after", False), ("balances", "balance_after", True))
        for picked in [F.when(condition, F.col(column))]
    }


def _compared() -> list[Column]:
    """The comparison from its sums and counts."""
    return [
        *[F.coalesce(f"_amount_{p}", F.lit(0)).alias(f"amount_{p}_30d") for p in ("last", "prev")],
        *[mean_of(F.col(f"_balance_{p}"), F.col(f"_balances_{p}")).alias(f"avg_balance_{p}_30d") for p in ("last", "prev")],
    ]


def period_comparison(grouped: GroupedData, day: Column, as_of) -> DataFrame:
    """Amounts and balances of the last 30 days against the 30 days before, per group."""
    sums = period_sums(day, as_of)
    out = grouped.agg(*[c.alias(n) for n, c in sums.items()])
    return out.select(*[c for c in out.columns if c not in sums], *_compared())


def churn_features(dim_customer: DataFrame, facts: DataFrame, dim_date: DataFrame, as_of=None) -> DataFrame:
    """Recency, 30/60/90-day activity, amount and balance trends per current customer.

    Every count and sum is taken once per transaction, and a customer without transactions has a lifetime count of 0.
    """
    used = with_full_date(facts.select(*CHURN_INPUT), dim_date)
    return described_churn(dim_customer, grouped_with_distinct(
        used, "customer_sk", "product_sk", "product_count", {**lifetime_parts(), **recent_parts(as_of)}), as_of)


#: Fact columns that the churn features read.
CHURN_INPUT = ("customer_sk", "product_sk", "date_key", "amount", "balance_after")


def lifetime_parts() -> Parts:
    """The aggregates of the churn features that do not depend on the as-of day."""
    day = F.col("full_date")
    return {"last_transaction_date": (F.max(day), F.max), "lifetime_tx_count": (F.count(day), F.sum)}


def recent_parts(as_of) -> Parts:
    """Those that do; facts of more than the longest window before that day add nothing to them."""
    day = F.col("full_date")
    lookbacks = lookback_counts(day, as_of, WINDOWS, "tx_count_last_")
    return {
        **{f"tx_count_last_{w}d": (count, F.sum) for w, count in zip(WINDOWS, lookbacks, strict=True)},
        **{name: (total, F.sum) for name, total in period_sums(day, as_of).items()},
    }


def described_churn(dim_customer: DataFrame, merged: DataFrame, as_of=None) -> DataFrame:
    """The churn features from the merged aggregates of each customer."""
    per_customer = merged.select("*", *_compared())
    today = D.as_of_date(as_of)
    inactive = F.datediff(today, "last_transaction_date") >= INACTIVE_DAYS
    features = (
        current_customers(dim_customer)
        .select("customer_sk", "customer_id", "income_bracket", "customer_segment", "account_open_date")
        .join(per_customer, "customer_sk", "left")
        .select(
            "customer_sk", "customer_id", "income_bracket", "customer_segment",
            D.tenure_months(F.col("account_open_date"), today).alias("tenure_months"),
            F.datediff(today, "last_transaction_date").alias("days_since_last_transaction"),
            *[f"tx_count_last_{w}d" for w in WINDOWS],
            "lifetime_tx_count", "amount_last_30d", "amount_prev_30d",
            relative_change(F.col("amount_last_30d").cast("double"), F.col("amount_prev_30d").cast("double")).alias("amount_trend"),
            "avg_balance_last_30d", "avg_balance_prev_30d",
            relative_change(F.col("avg_balance_last_30d"), F.col("avg_balance_prev_30d")).alias("balance_trend"),
            "product_count",
            F.when(inactive, 1).otherwise(0).alias("is_inactive"),
        )
    )
    return with_numbers_or_zero(features, features.columns[4:])
