"""Fraud features per transaction.

One narrow aggregate of the facts per customer and hour of the day yields the customer's mean and spread and the hourly
velocity. The gap to the previous transaction comes from the prefix scan of :mod:`starmart.operators.ordered`, so a
customer with a third of all rows, or with any number of rows of one moment, is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.columns import mean_of, number_or_zero, ratio, zscore
from starmart.functions.dates import elapsed_seconds
from starmart.operators.calendar import with_full_date
from starmart.operators.ordered import with_previous

_KEY, _HOUR = "customer_sk", "_hour"


def merchant_risk(facts: DataFrame) -> DataFrame:
    """Share of fraudulent transactions per merchant category."""
    flag = F.when(F.col("is_fraudulent"), 1.0).otherwise(0.0)
    return (
        facts.where(F.col("merchant_category").isNotNull())
        .groupBy("merchant_category")
        .agg((F.sum(flag) / F.count(F.lit(1))).alias("fraud_rate"))
    )


def _per_hour(count: Column, first: Column, last: Column) -> Column:
    """Transactions per hour of the span from first to last; NULL when the span is zero."""
    return ratio(count, elapsed_seconds(first, last) / F.lit(3600.0))


def hourly_velocity(facts: DataFrame) -> DataFrame:
    """Per customer and hour of day: count, and count over the hours between the first and the last transaction."""
    return (
        facts.groupBy(_KEY, F.hour("created_at").alias("tx_hour"))
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.min("created_at").alias("_first"),
            F.max("created_at").alias("_last"),
        )
        .select(_KEY, "tx_hour", "tx_count", _per_hour(F.col("tx_count"), F.col("_first"), F.col("_last")).alias("tx_per_hour"))
    )


def amount_stats(facts: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the amounts per customer."""
    return facts.groupBy(_KEY).agg(
        mean_of(F.sum("amount"), F.count("amount")).alias("mean_amount"),
        F.stddev_samp(F.col("amount").cast("double")).alias("stddev_amount"),
    )


def _statistics(facts: DataFrame) -> DataFrame:
    """One row per customer and hour of the day: the customer's mean and spread, and the velocity in that hour.

    Means and variances of the hours are merged into those of the customer by the parallel variance formula (Chan et al.
    1979). A customer with a single distinct amount gets a spread of exactly 0.
    """
    amount = F.col("amount").cast("double")
    per_hour = facts.groupBy(_KEY, F.hour("created_at").alias(_HOUR)).agg(
        F.count("created_at").alias("timed"),
        F.count("amount").alias("n"),
        F.sum("amount").alias("total"),
        F.coalesce(F.var_pop(amount) * F.count("amount"), F.lit(0.0)).alias("squares"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )
    whole = Window.partitionBy(_KEY)
    n = F.sum("n").over(whole)
    merged = per_hour.withColumns({
        "customer_n": n,
        "mean_amount": ratio(F.sum("total").over(whole), n),
        "flat": F.min("low").over(whole) == F.max("high").over(whole),
    })
    shift = ratio(F.col("total"), F.col("n")) - F.col("mean_amount")
    between = F.coalesce(F.col("n") * shift * shift, F.lit(0.0))
    spread = F.sqrt(ratio(F.sum(F.col("squares") + between).over(whole), F.col("customer_n") - 1))
    return merged.select(
        _KEY, _HOUR, "mean_amount",
        F.when(F.col("flat"), F.lit(0.0)).otherwise(spread).alias("stddev_amount"),
        _per_hour(F.col("timed"), F.col("first_at"), F.col("last_at")).alias("velocity"),
    )


def fraud_features(facts: DataFrame, dim_date: DataFrame, ordered: bool = True) -> DataFrame:
    """z-score, gap to the previous transaction, merchant risk, odd-hour flag and velocity of every transaction.

    Statistics are over all facts, the rows (and the gap between them) over facts whose date is in the calendar.
    """
    used = facts.select("transaction_sk", _KEY, "amount", "merchant_category", "channel", "created_at", "date_key")
    rows = with_full_date(used, dim_date).where(F.col("full_date").isNotNull()).drop("full_date", "date_key")
    hour = F.hour("created_at")
    # the hour is -1 where there is none, so that the join finds the customer's mean for such rows too
    numbered = with_previous(rows, _KEY, "created_at", "transaction_sk", "_previous").withColumn(_HOUR, F.coalesce(hour, F.lit(-1)))
    statistics = _statistics(used).withColumn(_HOUR, F.coalesce(_HOUR, F.lit(-1)))
    features = (
        numbered.join(statistics, [_KEY, _HOUR], "left")
        .join(merchant_risk(facts), "merchant_category", "left")
        .select(
            "transaction_sk", _KEY, "amount", "merchant_category", "channel", "created_at",
            hour.alias("tx_hour"),
            zscore(F.col("amount").cast("double"), F.col("mean_amount"), F.col("stddev_amount")).alias("amount_zscore"),
            number_or_zero(elapsed_seconds(F.col("_previous"), F.col("created_at"))).alias("time_since_last_tx"),
            F.coalesce("fraud_rate", F.lit(0.0)).alias("merchant_risk_score"),
            F.when(hour < 6, 1).otherwise(0).alias("unusual_hour_flag"),
            F.when(hour.isNotNull(), number_or_zero(F.col("velocity"))).otherwise(0.0).alias("hourly_velocity"),
        )
    )
    return features.orderBy(_KEY, "created_at", "transaction_sk") if ordered else features
