"""Calendar dimension. One row per day, so at most 401,767 rows over the usable key range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.functions import dates as D

#: Days between the smallest and largest usable date key: the proven size bound of every calendar.
MAX_CALENDAR_DAYS = 401_767

_FIRST_DAY, _LAST_DAY = "1900-01-01", "2999-12-31"


def days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``full_date`` from start to end, both included; empty when end lies before start."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"), F.to_date(F.lit(end)).alias("hi"))
    return _explode_days(bounds)


def days_spanned(df: DataFrame, date_column: str | Column) -> DataFrame:
    """``full_date`` from the earliest to the latest usable date of a column."""
    day = F.to_date(F.col(date_column) if isinstance(date_column, str) else date_column)
    usable = df.select(day.alias("day")).where(F.col("day").between(F.lit(_FIRST_DAY), F.lit(_LAST_DAY)))
    return _explode_days(usable.agg(F.min("day").alias("lo"), F.max("day").alias("hi")))


def _explode_days(bounds: DataFrame) -> DataFrame:
    # "greatest" keeps the sequence legal where the optimizer evaluates it ahead of the filter.
    days = F.sequence("lo", F.greatest("lo", "hi"), F.expr("interval 1 day"))
    return bounds.where("lo <= hi").select(F.explode(days).alias("full_date"))


def calendar_full(days: DataFrame) -> DataFrame:
    """Thirteen-column calendar with names, ISO week and a fiscal year that starts in April.

    The fiscal quarter is the calendar quarter and no day is a holiday.
    """
    d = F.col("full_date")
    return days.select(
        D.date_key(d).alias("date_key"),
        d,
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        D.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        D.fiscal_year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.weekofyear(d).alias("week_of_year"),
    )


def calendar_basic(days: DataFrame) -> DataFrame:
    """Eight-column calendar; ``day_of_week`` counts from Monday = 0 and ``is_weekend`` is 0 or 1."""
    d = F.col("full_date")
    return days.select(
        D.date_key(d).alias("date_sk"),
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.weekday(d).alias("day_of_week"),
        D.is_weekend(d).cast("int").alias("is_weekend"),
    ).dropDuplicates(["date_sk"])


def with_full_date(facts: DataFrame, dim_date: DataFrame, how: str = "left", columns: tuple[str, ...] = ()) -> DataFrame:
    """Add ``full_date`` (and further calendar columns) to facts.

    Only rows whose key is a real day between the bounds of a usable key count, and each key once; so what is broadcast
    is bounded by :data:`MAX_CALENDAR_DAYS`, and facts are never multiplied, whatever table is given.
    """
    day = D.date_from_key("date_key")
    usable = F.col("date_key").between(D.MIN_DATE_KEY, D.MAX_DATE_KEY) & day.isNotNull()
    wanted = dim_date.where(usable).select("date_key", "full_date", *columns).dropDuplicates(["date_key"])
    return facts.join(F.broadcast(wanted), "date_key", how)
