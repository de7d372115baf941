import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.operators import scd2
from starmart.operators.dedup import latest_version
from starmart.session import scratch_path
from starmart.sources.writers import write_parquet

AT = "2024-05-01 09:00:00"


def customers(spark, *rows):
    """Rows of (id, name, city, phone); the other attributes stay NULL."""
    df = spark.createDataFrame(list(rows), "customer_id string, customer_name string, city string, phone string")
    return contracts.DIM_CUSTOMER.conform(df).select("customer_id", *contracts.CUSTOMER_ATTRIBUTES)


def stored(df):
    """Write the dimension between batches, as a warehouse does."""
    path = scratch_path(df.sparkSession, "dim")
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def dim(spark):
    first = customers(spark, ("A", "a", "x", None), ("B", "b", "x", "1"), ("C", "c", "x", "1"))
    changes = scd2.detect_changes(first, spark.createDataFrame([], contracts.DIM_CUSTOMER.schema), "2024-01-01")
    return stored(scd2.apply_changes(spark.createDataFrame([], contracts.DIM_CUSTOMER.schema), changes, "2024-01-01"))


def versions(dim):
    return {(r.customer_id, r.version): r for r in dim.collect()}


def test_first_batch_is_all_new(dim):
    rows = versions(dim)
    assert set(rows) == {("A", 1), ("B", 1), ("C", 1)}
    assert sorted(r.customer_sk for r in rows.values()) == [1, 2, 3]
    assert all(r.is_current and r.expiry_date is None and r.effective_date == dt.date(2024, 1, 1) for r in rows.values())


def test_change_detection_is_null_safe(spark, dim):
    batch = customers(spark, ("A", "a", "x", None), ("B", "b", "x", None), ("D", "d", None, None))
    changes = {r.customer_id: r.version for r in scd2.detect_changes(batch, dim, AT).collect()}
    assert changes == {"B": 2, "D": 1}


def test_apply(spark, dim):
    batch = customers(spark, ("B", "b", "y", "1"), ("D", "d", None, None))
    after = scd2.apply_changes(dim, scd2.detect_changes(batch, dim, AT), AT)
    rows = versions(after)
    assert set(rows) == {("A", 1), ("B", 1), ("B", 2), ("C", 1), ("D", 1)}
    old, new = rows["B", 1], rows["B", 2]
    assert (old.is_current, old.expiry_date, old.city) == (False, dt.date(2024, 5, 1), "x")
    assert (new.is_current, new.effective_date, new.city, new.expiry_date) == (True, dt.date(2024, 5, 1), "y", None)
    assert old.customer_sk == versions(dim)["B", 1].customer_sk
    assert sorted(r.customer_sk for r in rows.values()) == [1, 2, 3, 4, 5]
    assert rows["C", 1].is_current  # absent from the batch, left alone
    assert scd2.history_violations(after).count() == 0
    assert {r.customer_id: r.version for r in latest_version(after).collect()} == {"A": 1, "B": 2, "C": 1, "D": 1}


def test_three_rounds_keep_the_invariants(spark, dim):
    state = dim
    for i, city in enumerate(("y", "z", "z")):
        batch = customers(spark, ("B", "b", city, "1"), (f"N{i}", "n", None, None))
        state = stored(scd2.apply_changes(state, scd2.detect_changes(batch, state, AT), AT))
    assert scd2.history_violations(state).count() == 0
    rows = versions(state)
    assert ("B", 3) in rows and ("B", 4) not in rows
    assert len({r.customer_sk for r in rows.values()}) == len(rows)


def test_next_day_variant(spark, dim):
    batch = customers(spark, ("B", "b", "y", "1"))
    rows = versions(scd2.apply_changes(dim, scd2.detect_changes(batch, dim, AT, effective_offset_days=1), AT))
    assert rows["B", 1].expiry_date == dt.date(2024, 5, 1) and rows["B", 2].effective_date == dt.date(2024, 5, 2)


def test_last_copy_in_the_batch_wins(spark, dim):
    batch = customers(spark, ("B", "b", "y", "1"), ("B", "b", "x", "1")).withColumn("seq", F.when(F.col("city") == "y", 1).otherwise(2))
    assert scd2.detect_changes(batch, dim, AT, order="seq").count() == 0


def test_tracked_columns(spark, dim):
    batch = customers(spark, ("B", "b", "y", "1"), ("C", "changed", "x", "1"))
    ids = lambda **k: {r.customer_id for r in scd2.detect_changes(batch, dim, AT, **k).collect()}
    assert ids(tracked=["customer_name"]) == {"C"}
    assert ids(tracked=[]) == set()


def test_absent_attributes_are_carried_over(spark, dim):
    batch = spark.createDataFrame([("B", "new name")], "customer_id string, customer_name string")
    row = scd2.detect_changes(batch, dim, AT, tracked=["customer_name"]).first()
    assert (row.customer_name, row.city, row.phone, row.version) == ("new name", "x", "1", 2)


def test_violations_are_found(spark, dim):
    broken = dim.unionByName(dim.where("customer_id = 'A'"))
    assert [r.customer_id for r in scd2.history_violations(broken).collect()] == ["A"]
