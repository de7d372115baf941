import datetime as dt

from pyspark.sql import functions as F

from starmart.operators import calendar, dedup
from starmart.operators.keys import assign_surrogate_keys


def test_full_calendar(spark):
    rows = {r.date_key: r for r in calendar.calendar_full(calendar.days_between(spark, "2020-12-31", "2021-04-01")).collect()}
    assert len(rows) == 92
    r = rows[20210103]
    assert (r.full_date, r.day_of_week, r.month_name, r.week_of_year) == (dt.date(2021, 1, 3), "Sunday", "January", 53)
    assert (r.is_weekend, r.is_holiday, r.fiscal_year, r.fiscal_quarter, r.quarter) == (True, False, 2020, 1, 1)
    assert rows[20210401].fiscal_year == 2021 and rows[20210401].fiscal_quarter == 2


def test_basic_calendar(spark):
    r = calendar.calendar_basic(calendar.days_between(spark, "2024-06-03", "2024-06-03")).first()
    assert tuple(r) == (20240603, dt.date(2024, 6, 3), 3, 6, 2024, 2, 0, 0)
    assert calendar.calendar_basic(calendar.days_between(spark, "2020-01-01", "2026-12-31")).count() == 2557


def test_calendar_of_reversed_or_empty_range(spark):
    assert calendar.days_between(spark, "2024-01-02", "2024-01-01").count() == 0
    assert calendar.days_spanned(spark.sql("SELECT CAST(NULL AS DATE) AS d"), "d").count() == 0


def test_calendar_ignores_dates_outside_the_key_range(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'0001-01-01'), (DATE'2024-01-01'), (DATE'2024-01-03') t(d)")
    assert calendar.days_spanned(df, "d").count() == 3


def test_longest_calendar_is_the_stated_bound(spark):
    assert calendar.days_between(spark, "1900-01-01", "2999-12-31").count() == calendar.MAX_CALENDAR_DAYS


def test_surrogate_keys_are_dense_and_repeatable(spark):
    ids = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("id"))
    stored = spark.sql("SELECT CAST(41 AS BIGINT) AS sk")
    many = ids.repartition(7)
    first = {r.id: r.sk for r in assign_surrogate_keys(many, "sk", stored).collect()}
    again = {r.id: r.sk for r in assign_surrogate_keys(many, "sk", stored).collect()}
    assert sorted(first.values()) == list(range(42, 1042))
    assert first == again


def test_surrogate_keys_move_no_rows(spark):
    """No window, no sort; the only exchange is none, and files are read in splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        keyed = assign_surrogate_keys(spark.range(20_000).select(F.col("id"), F.lit("x" * 30).alias("t")).coalesce(1), "sk")
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Window", "Sort ", "hashpartitioning", "SinglePartition"))
        assert keyed.rdd.getNumPartitions() > 1
        assert [r.sk for r in keyed.orderBy("id").collect()] == list(range(1, 20_001))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_surrogate_keys_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").cast("string").alias("id"))
    assert assign_surrogate_keys(empty, "sk").count() == 0
    assert assign_surrogate_keys(empty, "sk", spark.range(0).select(F.col("id").alias("sk"))).count() == 0


def test_keep_last_and_first(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), (None, 1, "n"), (None, 2, "m"), ("b", 1, "y")], "k string, seq int, v string"
    )
    assert {(r.k, r.v) for r in dedup.keep_last(df, "k", "seq").collect()} == {("a", None), (None, "m"), ("b", "y")}
    assert {(r.k, r.v) for r in dedup.keep_first(df, "k", "seq").collect()} == {("a", "x"), (None, "n"), ("b", "y")}
    assert dedup.keep_last(df, "k", "seq").columns == df.columns


def test_keep_last_has_no_window(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = dedup.keep_last(df, "k", "seq")._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_distinct_counts_ignore_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, None), (2, None)], "k int, v int")
    assert {tuple(r) for r in dedup.distinct_counts(df, "k", "v", "n").collect()} == {(1, 2)}
