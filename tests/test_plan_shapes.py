"""The physical plans that matter at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, Star
from starmart.operators import facts as fact_ops, scd2
from starmart.operators.keys import assign_surrogate_keys
from starmart.plans import churn, customer, fraud, performance, revenue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    """Facts stored as a table, so that plans show the library's work and not the fixture's joins."""
    from starmart.session import scratch_path

    s = Star(spark, FOLDER)
    path = scratch_path(spark, "facts")
    s.facts.write.parquet(path)
    s.facts = spark.read.parquet(path)
    return s


@pytest.fixture
def no_broadcast(spark):
    """As if every dimension were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_revenue_reads_five_columns_and_sums_before_it_joins(star):
    text = plan(revenue.monthly_revenue(star.facts, star.dates, star.products))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", text)[:2] == ["year", "date_key"] and "SortMergeJoin" not in text
    assert text.rindex("partial_sum(amount") > text.rindex("BroadcastHashJoin")
    scan = next(line for line in text.splitlines() if "FileScan" in line and "fee#" in line)
    assert len(re.findall(r"\w+#\d+", scan.split("[", 1)[1].split("]", 1)[0])) == 5


def test_large_dimensions_are_not_broadcast(star, no_broadcast):
    text = plan(fact_ops.lookup_keys_strict(star.raw_transactions, star.customers, star.products))
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text


def test_only_the_calendar_is_broadcast_unconditionally(star, no_broadcast):
    for df in (
        revenue.monthly_revenue(star.facts, star.dates, star.products),
        churn.churn_features(star.customers, star.facts, star.dates, AS_OF),
        customer.customer_features(star.customers, star.facts, star.dates, AS_OF),
        performance.product_performance(star.products, star.facts, star.dates),
    ):
        assert plan(df).count("BroadcastHashJoin") == 1


def test_snapshot_bound_reaches_the_scan(star):
    text = plan(customer.customer_snapshot(star.customers, star.facts, star.dates, "1999-06-30"))
    assert "LessThanOrEqual(date_key,19990630)" in text


def test_wide_aggregates_do_not_expand(star):
    for df in (
        customer.customer_features(star.customers, star.facts, star.dates, AS_OF),
        churn.churn_features(star.customers, star.facts, star.dates, AS_OF),
    ):
        assert "Expand" not in plan(df)


def test_facts_never_meet_in_one_partition(star, no_broadcast):
    """The only single-partition exchanges are over calendar bounds and scalar maxima."""
    keyed = assign_surrogate_keys(star.facts.select("transaction_id"), "transaction_sk")
    for df in (
        keyed,
        fraud.fraud_features(star.event_facts, star.event_dates),
        scd2.detect_changes(star.customer_batch, star.retail, AS_OF, order="seq"),
    ):
        text = plan(df)
        for block in re.finditer(r"Exchange SinglePartition.*\n(.*\n){3}", text):
            assert re.search(r"partial_(min|max)", block.group()), block.group()


def test_fraud_rows_are_clustered_by_run(star, no_broadcast):
    text = plan(fraud.fraud_features(star.event_facts, star.event_dates, ordered=False))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), 4\)", text)
    assert any(re.fullmatch(r"_run#\d+, customer_sk#\d+L", k) for k in keys) and "NestedLoop" not in text
    # the rows meet the statistics on customer and hour; only carries and the hourly statistics are clustered by customer alone
    assert any(re.fullmatch(r"customer_sk#\d+L, _hour#\d+", k) for k in keys)
    alone = [k for k in keys if re.fullmatch(r"customer_sk#\d+L", k)]
    assert len(alone) == 2


def test_no_python_workers_in_any_plan(star):
    for df in (
        customer.customer_features(star.customers, star.facts, star.dates, AS_OF),
        churn.churn_features(star.customers, star.facts, star.dates, AS_OF),
        fraud.fraud_features(star.event_facts, star.event_dates),
        scd2.detect_changes(star.customer_batch, star.retail, AS_OF, order="seq"),
        assign_surrogate_keys(star.facts.select("transaction_id"), "transaction_sk"),
    ):
        assert not re.search("Python|Pandas|Arrow", plan(df))


def test_feature_tables_scan_the_facts_once(star):
    for df in (
        customer.customer_features(star.customers, star.facts, star.dates, AS_OF),
        churn.churn_features(star.customers, star.facts, star.dates, AS_OF),
        customer.customer_snapshot(star.customers, star.facts, star.dates, "1999-06-30"),
        performance.product_performance(star.products, star.facts, star.dates),
    ):
        assert len(re.findall(r"FileScan parquet \[[^\]]*date_key", plan(df))) == 1


def test_snapshot_lists_no_later_months(star, spark, tmp_path):
    star.facts.withColumn("date_month", F.floor(F.col("date_key") / 100).cast("int")).limit(500).write.partitionBy("date_month").parquet(f"{tmp_path}/facts")
    text = plan(customer.customer_snapshot(star.customers, spark.read.parquet(f"{tmp_path}/facts"), star.dates, "1999-06-30"))
    assert re.search(r"PartitionFilters: \[[^\]]*date_month", text)
