import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starmart.operators import facts

RAW = "transaction_id string, customer_id string, product_id string, amount decimal(15,2), transaction_date date"


def dims(spark):
    customers = spark.createDataFrame(
        [("C1", 10, False), ("C1", 11, True), ("C2", 12, True), ("C3", 13, False)], "customer_id string, customer_sk long, is_current boolean"
    )
    products = spark.createDataFrame([("P1", 100)], "product_id string, product_sk long")
    return customers, products


def raw(spark):
    d = dt.date(2024, 1, 5)
    one = Decimal(1)
    return spark.createDataFrame([
        ("ok", "C1", "P1", one, d),
        (None, "C1", "P1", one, d), ("b", None, "P1", one, d), ("c", "C1", None, one, d), ("d", "C1", "P1", None, d), ("e", "C1", "P1", one, None),
        ("old", "C1", "P1", one, dt.date(1899, 12, 31)), ("first", "C2", "P1", one, dt.date(1900, 1, 1)),
        ("gone", "C3", "P1", one, d), ("nobody", "C9", "P1", one, d), ("nothing", "C1", "P9", one, d), ("neither", "C9", "P9", one, d),
    ], RAW)


def test_transform_drops_and_counts(spark):
    counts = facts.DropCounts()
    rows = {r.transaction_id: r for r in facts.transform_transactions(raw(spark), *dims(spark), counts).collect()}
    assert set(rows) == {"ok", "first"}
    assert (rows["ok"].customer_sk, rows["ok"].product_sk, rows["ok"].date_key) == (11, 100, 20240105)
    assert rows["first"].date_key == 19000101
    got = counts.get()
    assert got == {
        "rows_in": 12, "null_required": 5, "invalid_date": 1, "missing_customer": 3, "missing_product": 2, "rows_out": 2,
    }
    both_missing = 1
    assert got["rows_in"] == got["rows_out"] + got["null_required"] + got["invalid_date"] + got["missing_customer"] + got["missing_product"] - both_missing


def test_transform_of_nothing(spark):
    out = facts.transform_transactions(raw(spark).limit(0), *dims(spark))
    assert out.count() == 0 and {"customer_sk", "product_sk", "date_key"} <= set(out.columns)


def test_left_lookup_keeps_misses(spark):
    out = {r.transaction_id: (r.customer_sk, r.product_sk) for r in facts.lookup_keys(raw(spark), *dims(spark)).collect()}
    assert len(out) == 12 and out["gone"] == (None, 100) and out["neither"] == (None, None)


def test_absent_rows(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "id string, m int")
    stored = spark.createDataFrame([("a", 1), ("z", 1), (None, 1)], "id string, m int")
    rows = lambda df: sorted((r.id or "", r.m) for r in df.collect())
    assert rows(facts.absent_rows(batch, stored, "id")) == [("", 1), ("b", 1), ("b", 2)]
    assert len(rows(facts.absent_rows(batch, stored, "id", dedup_batch=True))) == 2
    assert rows(facts.absent_rows(batch, stored, "id", fixed_columns=("m",))) == [("", 1), ("b", 1), ("b", 2)]


def test_large_stored_side_is_filtered_by_a_broadcast_batch(spark):
    batch = spark.range(5).select(F.col("id").cast("string"))
    stored = spark.range(10_000_000).select(F.col("id").cast("string"))
    plan = facts.absent_rows(batch, stored, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_a_large_batch_is_worked_out_once(spark):
    """A batch too large to broadcast meets the stored keys as they are, with the rows that the semi join gave."""
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 1)], "id string, n int")
    stored = spark.createDataFrame([("a", 1), ("a", 9), ("z", 1), (None, 1)], "id string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fixed, wanted in ((), [("", 1), ("b", 1), ("b", 1)]), (("n",), [("", 1), ("a", 2), ("b", 1), ("b", 1)]):
            fresh = facts.absent_rows(batch, stored, "id", fixed_columns=fixed)
            assert sorted((r.id or "", r.n) for r in fresh.collect()) == wanted
            plan = fresh._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Join") == 1 and "LeftSemi" not in plan
        assert facts.absent_rows(batch, stored, "id", dedup_batch=True).count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_columns_keep_only_declared_ones(spark):
    df = spark.sql("SELECT 1 AS amount, 2 AS other, 'x' AS transaction_id")
    assert facts.fact_columns(df).columns == ["transaction_id", "amount"]
