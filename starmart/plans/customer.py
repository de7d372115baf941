"""Customer features and the periodic customer snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions import dates as D
from starmart.functions.columns import mean_of, with_numbers_or_zero
from starmart.operators.calendar import with_full_date
from starmart.operators.dedup import Parts, grouped_with_distinct
from starmart.operators.facts import current_customers

#: Channels that get a transaction count of their own. Fixed values.
CHANNELS = ("Online", "Mobile", "ATM", "Branch")


def credit_debit_totals() -> list[Column]:
    def total(kind):
        return F.sum(F.when(F.col("transaction_type") == kind, F.col("amount")).otherwise(0))

    return [total("Credit").alias("total_credits"), total("Debit").alias("total_debits")]


def channel_counts() -> list[Column]:
    """Transactions per channel. A fact row is one transaction, so a conditional count needs no distinct."""
    return [F.count_if(F.col("channel") == c).alias(f"{c.lower()}_tx_count") for c in CHANNELS]


#: Fact columns that :func:`customer_parts` reads, besides the day.
CUSTOMER_INPUT = ("customer_sk", "product_sk", "date_key", "transaction_type", "channel", "amount", "balance_after")


def customer_parts() -> Parts:
    """The aggregates behind the customer features, each with what merges it over groups of rows."""
    amount = F.col("amount").cast("double")
    credits, debits = credit_debit_totals()
    return {
        "total_transactions": (F.count(F.lit(1)), F.sum),
        "total_credits": (credits, F.sum), "total_debits": (debits, F.sum),
        "_total": (F.sum("amount"), F.sum), "_n": (F.count("amount"), F.sum),
        # of the squared distances from the mean: those inside each product, and what shifts them to the common mean
        "_inside": (F.var_pop(amount) * F.count("amount"), F.sum), "_shift": (F.pow(F.sum(amount), 2) / F.nullif(F.count("amount"), F.lit(0)), F.sum),
        "_low": (F.min("amount"), F.min), "_high": (F.max("amount"), F.max),
        "last_transaction_date": (F.max("full_date"), F.max),
        **{f"{c.lower()}_tx_count": (count, F.sum) for c, count in zip(CHANNELS, channel_counts(), strict=True)},
        "_balances": (F.sum("balance_after"), F.sum), "_balance_n": (F.count("balance_after"), F.sum),
    }


def customer_features(dim_customer: DataFrame, facts: DataFrame, dim_date: DataFrame, as_of=None) -> DataFrame:
    """Demographics, totals, spread, recency, holdings and channel use of every current customer."""
    used = with_full_date(facts.select(*CUSTOMER_INPUT), dim_date)
    return described_customers(dim_customer, grouped_with_distinct(used, "customer_sk", "product_sk", "product_count", customer_parts()), as_of)


def described_customers(dim_customer: DataFrame, merged: DataFrame, as_of=None) -> DataFrame:
    """The customer features from the merged aggregates of each customer."""
    squares = F.col("_inside") + F.col("_shift") - F.pow(F.col("_total").cast("double"), 2) / F.col("_n")
    spread = F.when(F.col("_n") > 1, F.when(F.col("_low") == F.col("_high"), 0.0).otherwise(F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("_n") - 1))))
    per_customer = merged.withColumns({
        "avg_transaction_amount": mean_of(F.col("_total"), F.col("_n")),
        "stddev_transaction_amount": spread,
        "avg_balance": mean_of(F.col("_balances"), F.col("_balance_n")),
    })
    today = D.as_of_date(as_of)
    described = ["customer_sk", "customer_id", "customer_name", "gender", "income_bracket", "customer_segment", "city",
                 "state", "account_open_date", "date_of_birth"]
    channels = [f"{c.lower()}_tx_count" for c in CHANNELS]
    features = (
        current_customers(dim_customer).select(*described)
        .join(per_customer, "customer_sk", "left")
        .select(
            *described,
            D.completed_years(F.col("date_of_birth"), today).alias("age"),
            D.tenure_months(F.col("account_open_date"), today).alias("tenure_months"),
            "total_transactions", "total_credits", "total_debits", "avg_transaction_amount",
            "stddev_transaction_amount", "last_transaction_date",
            F.datediff(today, "last_transaction_date").alias("days_since_last_transaction"),
            "product_count", *channels, "avg_balance",
        )
    )
    numbers = [c for c in features.columns[10:] if c != "last_transaction_date"]
    return with_numbers_or_zero(features, numbers)


def customer_snapshot(dim_customer: DataFrame, facts: DataFrame, dim_date: DataFrame, snapshot_date: str) -> DataFrame:
    """State of every current customer at a date, from the facts up to and including it.

    The bound is applied to ``date_key`` as well, which Parquet's statistics can use, and to ``date_month`` where the
    facts are partitioned by it, so that later months are not listed or read.
    """
    at = F.to_date(F.lit(snapshot_date))
    bound = F.col("date_key") <= D.date_key(at)
    if "date_month" in facts.columns:
        bound = bound & (F.col("date_month") <= F.floor(D.date_key(at) / 100).cast("int"))
    until = facts.where(bound).select(
        "customer_sk", "date_key", "product_sk", "amount", "balance_after"
    )
    dated = with_full_date(until, dim_date, "inner").where(F.col("full_date") <= at)
    per_customer = grouped_with_distinct(dated, "customer_sk", "product_sk", "num_products", {
        "total_transactions": (F.count(F.lit(1)), F.sum),
        "total_amount": (F.sum("amount"), F.sum), "_n": (F.count("amount"), F.sum),
        "account_balance": (F.max("balance_after"), F.max),
        "last_date": (F.max("full_date"), F.max),
    }).withColumn("avg_transaction_amount", mean_of(F.col("total_amount"), F.col("_n")))
    snapshot = (
        current_customers(dim_customer).select("customer_sk")
        .join(per_customer, "customer_sk", "left")
        .select(
            D.date_key(at).alias("date_key"),
            "customer_sk", "total_transactions", "total_amount", "avg_transaction_amount", "account_balance",
            "num_products",
            F.datediff(at, "last_date").alias("days_since_last_transaction"),
            F.coalesce(F.col("last_date") >= F.date_sub(at, 30), F.lit(False)).alias("is_active"),
        )
    )
    return with_numbers_or_zero(snapshot, snapshot.columns[2:-1])
