"""Cross-sell affinity between products, and cross-sell features per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions import dates as D
from starmart.functions.columns import age_group
from starmart.operators.baskets import column_names, described_pairs, owner_counts, ownership, pair_support, supported_pairs
from starmart.operators.dedup import Parts
from starmart.operators.facts import current_customers
from starmart.session import staged

# --- fixed values: default thresholds ---------------------------------------------------------------------
MIN_SUPPORT = 0.01
AFFINITY_THRESHOLD = 0.1
# ----------------------------------------------------------------------------------------------------------


def cross_sell_affinity(
    facts: DataFrame,
    dim_product: DataFrame,
    min_support: float = MIN_SUPPORT,
    affinity_threshold: float = AFFINITY_THRESHOLD,
    with_lift: bool = False,
) -> DataFrame:
    """Product pairs held by the same customers, with the support seen from either product.

    A pair is kept when one of its supports reaches ``min_support`` and is strong when one exceeds the threshold.
    """
    owned = staged(ownership(facts), "owned")
    most = owner_counts(owned).agg(F.max("owners")).first()[0] or 0
    pairs = supported_pairs(owned, min_support, most_owners=most)
    out = pair_support(described_pairs(pairs, dim_product, ["product_id", "product_name"], most))
    strong = (F.col("support_a") > affinity_threshold) | (F.col("support_b") > affinity_threshold)
    columns: list[str | Column] = [
        F.col("product_id_a").alias("product_a_id"), F.col("product_name_a").alias("product_a_name"),
        F.col("product_id_b").alias("product_b_id"), F.col("product_name_b").alias("product_b_name"), "n_together", "support_a", "support_b",
        F.when(strong, 1).otherwise(0).alias("strong_affinity"),
    ]
    if with_lift:
        holders = owned.agg(F.countDistinct("customer_sk").cast("double")).scalar()
        columns.append((F.col("support_a") * holders / F.col("owners_b")).alias("lift"))
    return out.select(*columns)


def cross_sell_features(
    dim_customer: DataFrame,
    facts: DataFrame,
    dim_product: DataFrame,
    as_of=None,
    product_categories: Sequence[str] | None = None,
    transaction_categories: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
) -> DataFrame:
    """Owned categories, three pivots and demographics of every current customer with transactions.

    All pivots group by customer, so they are conditional aggregates of one grouping: one shuffle of pre-aggregated
    rows in place of a pivot and a join each. Facts are summed by customer, product, category and channel before they
    meet the products. The value lists become columns. A list that is not given is read from the data, in order, and there may
    be no more values than ``spark.sql.pivotMaxValues`` allows; a value that a given list does not hold is an error when the rows are read. NULL has no column.
    """
    used = facts.groupBy(*SPEND_KEYS).agg(*[first.alias(c) for c, (first, _) in spend_parts().items()])
    return described_spend(dim_customer, used, dim_product, as_of, product_categories, transaction_categories, channels)


#: What the spend behind the cross-sell features is summed by.
SPEND_KEYS = ("customer_sk", "product_sk", "transaction_category", "channel")


def spend_parts() -> Parts:
    return {"amount": (F.sum("amount"), F.sum), "_n": (F.count("amount"), F.sum)}


def described_spend(
    dim_customer: DataFrame, used: DataFrame, dim_product: DataFrame, as_of=None, product_categories: Sequence[str] | None = None,
    transaction_categories: Sequence[str] | None = None, channels: Sequence[str] | None = None,
) -> DataFrame:
    """The cross-sell features from the spend by customer, product, category and channel."""
    sold = used.join(dim_product.select("product_sk", "product_category"), "product_sk")
    given = {"product_category": product_categories, "transaction_category": transaction_categories, "channel": channels}
    absent = [c for c, values in given.items() if values is None]
    if absent:
        held = sold.select(*absent).distinct().select(F.explode(F.array(*(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in absent))).alias("x"))
        # each value becomes a column, so what reaches the driver is bounded like the values of a pivot
        limit = int(dim_customer.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = held.select("x.*").where("value IS NOT NULL").distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} values of {', '.join(absent)} (spark.sql.pivotMaxValues): give the wanted ones")
        given |= {c: sorted(r.value for r in found if r.column == c) for c in absent}
    product_categories, transaction_categories, channels = given.values()

    def listed(column: str, values: Sequence[str]) -> Column:
        known = F.col(column).isNull() | F.col(column).isin(*values)
        unlisted = F.raise_error(F.concat(F.lit(f"{column} not among the given values: "), F.col(column))).cast("string")
        return F.when(known, F.col(column)).otherwise(unlisted)

    sold = sold.withColumns({c: listed(c, values) for c, values in given.items() if c not in absent})

    def spend(column: str, values: Sequence[str], prefix: str) -> list[Column]:
        return [
            F.coalesce(F.sum(F.when(F.col(column) == v, F.col("amount"))), F.lit(0)).alias(name)
            for v, name in zip(values, column_names(prefix, values), strict=True)
        ]

    per_customer = sold.groupBy("customer_sk").agg(
        F.array_sort(F.collect_set("product_category")).alias("current_products"),
        *[
            F.coalesce(F.sum(F.when(F.col("product_category") == c, F.col("_n"))), F.lit(0)).alias(name)
            for c, name in zip(product_categories, column_names("prod_count_", product_categories), strict=True)
        ],
        *spend("transaction_category", transaction_categories, "cat_spend_"),
        *spend("channel", channels, "chan_spend_"),
    )
    demographics = current_customers(dim_customer).select(
        "customer_sk", "income_bracket",
        age_group(D.completed_years(F.col("date_of_birth"), D.as_of_date(as_of))).alias("age_group"),
    )
    return per_customer.join(demographics, "customer_sk")
