"""Product performance and regional analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.columns import mean_of, with_numbers_or_zero
from starmart.operators.calendar import with_full_date
from starmart.operators.dedup import Parts, grouped_with_distinct
from starmart.operators.facts import current_customers

_MEASURES = ["transaction_count", "customer_count", "total_revenue", "avg_transaction_amount", "avg_balance"]


def product_performance(dim_product: DataFrame, facts: DataFrame, dim_date: DataFrame, ordered: bool = True) -> DataFrame:
    """Volume, revenue and reach of every active product, sold or not, best revenue first.

    Facts are grouped by (product, customer) first, which spreads a product with a third of all rows over its customers
    and makes the distinct customers a count of rows.
    """
    used = facts.select("product_sk", "customer_sk", "date_key", "amount", "balance_after")
    return described_products(dim_product, grouped_with_distinct(
        with_full_date(used, dim_date), "product_sk", "customer_sk", "customer_count", product_parts()), ordered)


def product_parts() -> Parts:
    """The aggregates behind the product performance, each with what merges it over groups of rows."""
    return {
        "transaction_count": (F.count(F.lit(1)), F.sum),
        "total_revenue": (F.sum("amount"), F.sum), "_n": (F.count("amount"), F.sum),
        "_balances": (F.sum("balance_after"), F.sum), "_balance_n": (F.count("balance_after"), F.sum),
        "first_transaction_date": (F.min("full_date"), F.min),
        "last_transaction_date": (F.max("full_date"), F.max),
    }


def described_products(dim_product: DataFrame, merged: DataFrame, ordered: bool = True) -> DataFrame:
    """The product performance from the merged aggregates of each product."""
    per_product = merged.withColumns({
        "avg_transaction_amount": mean_of(F.col("total_revenue"), F.col("_n")),
        "avg_balance": mean_of(F.col("_balances"), F.col("_balance_n")),
    })
    described = ["product_sk", "product_id", "product_name", "product_category", "product_type"]
    out = (
        dim_product.where("is_active").select(*described)
        .join(per_product, "product_sk", "left")
        .select(
            *described, "transaction_count", "customer_count", "total_revenue", "avg_transaction_amount", "avg_balance",
            "first_transaction_date", "last_transaction_date",
        )
    )
    return with_numbers_or_zero(_best_first(out, ordered), _MEASURES)


def regional_analysis(facts: DataFrame, dim_customer: DataFrame, ordered: bool = True) -> DataFrame:
    """Volume, revenue and customers by state and city of current customers, best revenue first.

    Facts are summed per customer first. Each customer is then one row, which makes the distinct count a plain count
    and the join customer-sized.
    """
    per_customer = facts.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("n_amount"),
        F.sum("balance_after").alias("balance"),
        F.count("balance_after").alias("n_balance"),
    )
    return regions(per_customer, dim_customer, ordered)


def regions(per_customer: DataFrame, dim_customer: DataFrame, ordered: bool = True) -> DataFrame:
    """The regional analysis from ``n, amount, n_amount, balance, n_balance`` of each customer."""
    out = (
        per_customer.join(current_customers(dim_customer).select("customer_sk", "state", "city"), "customer_sk")
        .groupBy("state", "city")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("amount").alias("total_revenue"),
            mean_of(F.sum("amount"), F.sum("n_amount")).alias("avg_transaction_amount"),
            mean_of(F.sum("balance"), F.sum("n_balance")).alias("avg_balance"),
        )
    )
    return with_numbers_or_zero(_best_first(out, ordered), _MEASURES)


def _best_first(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy(F.col("total_revenue").desc_nulls_last()) if ordered else df
