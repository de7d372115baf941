import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.operators.calendar import calendar_full, days_between
from starmart.plans import churn, customer, fraud, performance, revenue

AT = "2024-03-31 12:00:00"


@pytest.fixture(scope="module")
def dates(spark):
    return calendar_full(days_between(spark, "2023-01-01", "2024-12-31"))


def customers(spark, n):
    return spark.range(1, n + 1).select(
        F.col("id").alias("customer_sk"), F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("n").alias("customer_name"),
        F.lit("f").alias("gender"), F.lit("i").alias("income_bracket"), F.lit("s").alias("customer_segment"),
        F.lit("city").alias("city"), F.lit("st").alias("state"), F.lit("2024-01-31").cast("date").alias("account_open_date"),
        F.lit("2000-02-29").cast("date").alias("date_of_birth"), (F.col("id") < n).alias("is_current"),
    )


def facts(spark, *rows):
    """Rows of (customer, date, amount, product)."""
    df = spark.createDataFrame([(i, c, int(d.replace("-", "")), a, p) for i, (c, d, a, p) in enumerate(rows)],
                               "transaction_sk long, customer_sk long, date_key int, amount double, product_sk long")
    return df.withColumns({
        "amount": F.col("amount").cast("decimal(15,2)"), "balance_after": (F.col("amount") * 2).cast("decimal(15,2)"),
        "fee": F.lit(0).cast("decimal(15,2)"), "transaction_type": F.when(F.col("amount") < 50, "Debit").otherwise("Credit"),
        "channel": F.lit("Online"),
    })


def by(df, key="customer_sk"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_churn_boundaries(spark, dates):
    """As of noon, day 60 is already beyond 60 days."""
    f = facts(spark, (1, "2024-01-31", 1.0, 1), (2, "2024-02-01", 1.0, 1), (3, "2024-03-01", 1.0, 1), (4, "2024-03-02", 1.0, 1),
              (5, "2024-04-05", 1.0, 1), (7, "2024-03-31", 1.0, 1))
    rows = by(churn.churn_risk(customers(spark, 7), f, dates, AT))
    assert {k: (r["days_since_last_txn"], r["churn_status"]) for k, r in rows.items()} == {
        1: (60, "Churned"), 2: (59, "At Risk"), 3: (30, "At Risk"), 4: (29, "Active"), 5: (-4, "Active"), 6: (None, "Active"),
    }
    assert rows[3]["txn_last_30d"] == 1 and rows[2]["txn_last_30d"] == 0 and rows[2]["txn_last_60d"] == 1
    assert rows[6]["total_transactions"] == 0 and rows[6]["txn_last_90d"] == 0


def test_churn_counts_facts_outside_the_calendar(spark, dates):
    r = by(churn.churn_risk(customers(spark, 2), facts(spark, (1, "2030-01-01", 1.0, 1)), dates, AT, windows=[7]))[1]
    assert (r["total_transactions"], r["last_transaction_date"], r["churn_status"], r["txn_last_7d"]) == (1, None, "Active", 0)


def test_churn_features(spark, dates):
    f = facts(spark, (1, "2024-03-31", 30.0, 1), (1, "2024-02-15", 20.0, 2), (1, "2024-02-10", 20.0, 1), (2, "2023-06-01", 5.0, 1), (2, "2024-03-31", 7.0, 1))
    rows = by(churn.churn_features(customers(spark, 4), f, dates, AT))
    one = rows[1]
    assert (one["lifetime_tx_count"], one["tx_count_last_30d"], one["tx_count_last_60d"], one["product_count"]) == (3, 1, 3, 2)
    assert (one["amount_last_30d"], one["amount_prev_30d"], one["amount_trend"]) == (30, 40, -0.25)
    assert (one["avg_balance_last_30d"], one["avg_balance_prev_30d"], one["balance_trend"]) == (60.0, 40.0, 0.5)
    assert one["tenure_months"] == 2.0 and one["is_inactive"] == 0
    assert rows[2]["amount_trend"] == 0 and rows[2]["balance_trend"] == 0
    assert rows[3]["lifetime_tx_count"] == 0 and rows[3]["days_since_last_transaction"] == 0 and rows[3]["is_inactive"] == 0


def test_customer_features(spark, dates):
    f = facts(spark, (1, "2024-03-30", 10.0, 1), (1, "2024-03-01", 90.0, 2), (2, "2024-03-01", 10.0, 2))
    rows = by(customer.customer_features(customers(spark, 4), f, dates, AT))
    assert set(rows) == {1, 2, 3}
    one = rows[1]
    assert (one["total_credits"], one["total_debits"], one["avg_transaction_amount"], one["avg_balance"]) == (90, 10, 50.0, 100.0)
    assert one["stddev_transaction_amount"] == pytest.approx(56.568542, abs=1e-6)
    assert (one["age"], one["days_since_last_transaction"], one["product_count"], one["online_tx_count"], one["atm_tx_count"]) == (24, 1, 2, 2, 0)
    assert rows[2]["stddev_transaction_amount"] == 0
    assert rows[3]["total_transactions"] == 0 and rows[3]["last_transaction_date"] is None


def test_snapshot_ignores_later_facts(spark, dates):
    f = facts(spark, (1, "2024-03-01", 10.0, 1), (1, "2024-03-31", 30.0, 2), (1, "2024-04-01", 90.0, 3), (2, "2024-02-29", 5.0, 1), (3, "2024-05-01", 1.0, 1))
    rows = by(customer.customer_snapshot(customers(spark, 5), f, dates, "2024-03-31"))
    one = rows[1]
    assert (one["date_key"], one["total_transactions"], one["total_amount"], one["avg_transaction_amount"]) == (20240331, 2, 40, 20.0)
    assert (one["account_balance"], one["num_products"], one["days_since_last_transaction"], one["is_active"]) == (60, 2, 0, True)
    assert rows[2]["is_active"] is False and rows[2]["days_since_last_transaction"] == 31
    assert rows[3]["total_transactions"] == 0 and rows[3]["is_active"] is False and rows[4]["total_amount"] == 0


def test_product_performance_lists_unsold_and_leaves_out_inactive(spark, dates):
    products = spark.sql("""SELECT product_sk, 'P' AS product_id, 'n' AS product_name, 'c' AS product_category, 't' AS product_type, is_active
        FROM VALUES (1L, true), (2L, true), (3L, false), (4L, true) t(product_sk, is_active)""")
    f = facts(spark, (1, "2024-03-01", 10.0, 1), (2, "2024-03-02", 20.0, 1), (1, "2024-03-03", 99.0, 2), (1, "2024-03-03", 5.0, 3))
    rows = performance.product_performance(products, f, dates).collect()
    assert [r.product_sk for r in rows] == [2, 1, 4]
    assert (rows[1].customer_count, rows[1].total_revenue, rows[1].first_transaction_date) == (2, 30, dt.date(2024, 3, 1))
    assert (rows[2].transaction_count, rows[2].total_revenue, rows[2].last_transaction_date) == (0, 0, None)


def test_regional_analysis(spark):
    c = customers(spark, 4).withColumn("state", F.when(F.col("customer_sk") == 1, "A").otherwise("B"))
    f = facts(spark, (1, "2024-03-01", 10.0, 1), (2, "2024-03-01", 20.0, 1), (2, "2024-03-01", 30.0, 1), (3, "2024-03-01", 1.0, 1), (4, "2024-03-01", 500.0, 1))
    rows = [(r.state, r.transaction_count, r.customer_count, r.total_revenue) for r in performance.regional_analysis(f, c).collect()]
    assert rows == [("B", 3, 2, 51), ("A", 1, 1, 10)]


def test_monthly_revenue_groups(spark, dates):
    products = spark.sql("SELECT 1L AS product_sk, 'c' AS product_category")
    f = facts(spark, (1, "2024-03-01", 10.0, 1), (2, "2024-03-31", 20.0, 1), (1, "2024-04-01", 5.0, 1), (1, "2024-04-01", 5.0, 2), (1, "2030-04-01", 5.0, 1))
    rows = {(r.year, r.month): (r.transaction_count, r.total_amount) for r in revenue.monthly_revenue(f, dates, products).collect()}
    assert rows == {(2024, 3): (2, 30), (2024, 4): (1, 5)}


FRAUD = "transaction_sk long, customer_sk long, created_at timestamp, amount decimal(15,2), merchant_category string, is_fraudulent boolean"


def fraud_facts(spark):
    t = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    from decimal import Decimal as D
    return spark.createDataFrame([
        (1, 1, t(1, 3), D("10.10"), "m", True), (2, 1, t(1, 3, 30), D("10.10"), "m", False), (3, 1, t(2, 3, 30), D("10.10"), None, None),
        (4, 2, t(1, 23), D(1), "x", None), (5, 3, t(1, 6), D(1), "x", False), (6, 3, t(1, 6), D(3), "x", False), (7, 3, None, D(5), "x", True),
    ], FRAUD).withColumns({
        "channel": F.lit("POS"),
        "date_key": F.coalesce(F.date_format("created_at", "yyyyMMdd").cast("int"), F.lit(20240105)),
    })


def test_fraud_features(spark, dates):
    rows = by(fraud.fraud_features(fraud_facts(spark), dates), "transaction_sk")
    assert [rows[i]["amount_zscore"] for i in (1, 2, 3, 4)] == [0, 0, 0, 0]  # equal amounts, and a single one
    assert rows[6]["amount_zscore"] == 0 and rows[5]["amount_zscore"] == pytest.approx(-1) and rows[7]["amount_zscore"] == pytest.approx(1)
    assert [rows[i]["time_since_last_tx"] for i in (1, 2, 3, 4, 5, 6, 7)] == [0, 1800, 86400, 0, 0, 0, 0]
    assert rows[1]["merchant_risk_score"] == 0.5 and rows[3]["merchant_risk_score"] == 0 and rows[4]["merchant_risk_score"] == 0.25
    assert [rows[i]["unusual_hour_flag"] for i in (1, 4, 5, 7)] == [1, 0, 0, 0]
    assert rows[1]["hourly_velocity"] == pytest.approx(3 / 24.5) and rows[5]["hourly_velocity"] == 0 and rows[7]["hourly_velocity"] == 0


def test_fraud_rows_need_a_calendar_day_but_statistics_do_not(spark, dates):
    rows = by(fraud.fraud_features(fraud_facts(spark), dates.where("date_key <> 20240101")), "transaction_sk")
    assert set(rows) == {3, 7}
    assert rows[3]["time_since_last_tx"] == 0 and rows[3]["hourly_velocity"] == pytest.approx(3 / 24.5)


def test_fraud_statistics_against_plain_aggregates(spark):
    """Merged slice statistics equal the direct mean and deviation."""
    f = spark.range(3000).select(
        F.col("id").alias("transaction_sk"), (F.col("id") % 5).alias("customer_sk"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 977).alias("created_at"),
        (F.pmod(F.xxhash64("id"), F.lit(100000)) / 100).cast("decimal(15,2)").alias("amount"),
        F.lit("m").alias("merchant_category"), F.lit("c").alias("channel"), F.lit(False).alias("is_fraudulent"),
    ).withColumn("date_key", F.date_format("created_at", "yyyyMMdd").cast("int"))
    days = calendar_full(days_between(spark, "2024-01-01", "2024-12-31"))
    plain = f.join(fraud.amount_stats(f), "customer_sk").select(
        "transaction_sk", ((F.col("amount").cast("double") - F.col("mean_amount")) / F.col("stddev_amount")).alias("z"))
    both = fraud.fraud_features(f, days, ordered=False).join(plain, "transaction_sk")
    assert both.count() == 3000 and both.where("abs(amount_zscore - z) > 1e-9").count() == 0


def test_empty_facts(spark, dates):
    none = facts(spark, (1, "2024-03-01", 1.0, 1)).where("amount < 0")
    assert churn.churn_risk(customers(spark, 3), none, dates, AT).count() == 2
    assert revenue.monthly_revenue(none, dates, spark.sql("SELECT 1L AS product_sk, 'c' AS product_category")).count() == 0
    assert fraud.fraud_features(fraud_facts(spark).where("amount < 0"), dates).count() == 0
