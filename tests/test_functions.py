import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.functions import columns as C, dates as D


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def day(text):
    return F.lit(text).cast("date")


def test_date_key_round_trip(spark):
    assert one(spark, D.date_key(day("2024-02-29"))) == 20240229
    assert one(spark, D.date_key(F.lit(None).cast("date"))) is None
    assert one(spark, D.date_from_key(F.lit(20240229))) == dt.date(2024, 2, 29)
    assert one(spark, D.date_from_key(F.lit(20240231))) is None


@pytest.mark.parametrize("text, weekend, payday", [
    ("2024-06-01", True, True), ("2024-06-02", True, False), ("2024-06-03", False, False), ("2024-07-15", False, True),
])
def test_weekend_and_payday(spark, text, weekend, payday):
    assert one(spark, D.is_weekend(day(text))) is weekend
    assert one(spark, D.is_payday(day(text))) is payday


def test_fiscal_year_starts_in_april(spark):
    assert one(spark, D.fiscal_year(day("2024-03-31"))) == 2023
    assert one(spark, D.fiscal_year(day("2024-04-01"))) == 2024


@pytest.mark.parametrize("birth, at, years", [
    ("2000-02-29", "2024-02-28", 23), ("2000-02-29", "2024-02-29", 24), ("2000-02-29", "2023-03-01", 23),
    ("1990-05-10", "2020-05-09", 29), ("1990-05-10", "2020-05-10", 30), ("2021-01-01", "2020-07-01", 0),
])
def test_completed_years(spark, birth, at, years):
    assert one(spark, D.completed_years(day(birth), day(at))) == years


def test_elapsed_days_keep_the_time_of_day(spark):
    elapsed = D.elapsed_days(day("2024-01-01"), D.as_of_timestamp("2024-03-01 12:00:00"))
    assert one(spark, elapsed) == 60.5
    assert one(spark, D.elapsed_days(day("2024-01-02"), D.as_of_timestamp("2024-01-01"))) == -1.0


def test_as_of_defaults_to_now(spark):
    assert abs((one(spark, D.as_of_timestamp()) - dt.datetime.now(dt.UTC).replace(tzinfo=None)).total_seconds()) < 86400


@pytest.mark.parametrize("age, band", [
    (0, "18-25"), (24, "18-25"), (25, "26-35"), (34, "26-35"), (35, "36-45"), (45, "46-55"), (55, "56-65"), (65, "65+"),
    (99, "65+"), (100, None), (-1, None), (None, "18-25"),
])
def test_age_group(spark, age, band):
    assert one(spark, C.age_group(F.lit(age).cast("int"))) == band


@pytest.mark.parametrize("score, band", [
    (750, "low"), (749, "medium"), (650, "medium"), (649, "high"), (550, "high"), (549, "very_high"), (None, "very_high"),
])
def test_risk_category(spark, score, band):
    assert one(spark, C.risk_category(F.lit(score).cast("int"))) == band


def test_descriptions(spark):
    assert one(spark, C.describe_transaction(F.lit("debit"), F.lit("grocery"))) == "Purchase at grocery"
    assert one(spark, C.describe_transaction(F.lit("odd"), F.lit("grocery"))) == "odd grocery"


def test_signed_amount(spark):
    for kind, sign in (("credit", 1), ("direct_deposit", 1), ("transfer", 1), ("debit", -1), ("atm_withdrawal", -1)):
        assert one(spark, C.signed_amount(F.lit(kind), F.lit(5))) == 5 * sign


@pytest.mark.parametrize("text, number", [("12.5", 12.5), ("x", 0.0), (None, 0.0), ("NaN", 0.0), (" 7 ", 7.0)])
def test_number_or_zero(spark, text, number):
    assert one(spark, C.number_or_zero(F.lit(text).cast("string"))) == number


def test_numbers_keep_their_type(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(9,2)) AS d, CAST(NULL AS BIGINT) AS l, 'a' AS s, CAST(NULL AS DOUBLE) AS f")
    out = C.with_numbers_or_zero(df, df.columns)
    assert [t for _, t in out.dtypes] == ["decimal(9,2)", "bigint", "double", "double"]
    assert list(out.first()) == [0, 0, 0.0, 0.0]


def test_guarded_ratios(spark):
    lit = F.lit
    assert one(spark, C.relative_change(lit(3.0), lit(0.0))) == 0
    assert one(spark, C.relative_change(lit(3.0), lit(-2.0))) == 0
    assert one(spark, C.relative_change(lit(3.0), lit(2.0))) == 0.5
    assert one(spark, C.zscore(lit(3.0), lit(1.0), lit(0.0))) == 0
    assert one(spark, C.zscore(lit(3.0), lit(1.0), lit(None).cast("double"))) == 0
    assert one(spark, C.zscore(lit(3.0), lit(1.0), lit(4.0))) == 0.5
    assert one(spark, C.ratio(lit(1), lit(0))) is None


@pytest.mark.parametrize("fmt, text, ok", [
    ("%Y-%m-%d", "2024-01-05", True), ("%Y-%m-%d", "2024-1-5", True), ("%Y-%m-%d", "2024-13-01", False),
    ("%Y-%m-%d", "2024-01-05 10:00", False), ("%d/%m/%Y", "05/01/2024", True), ("%d.%m.%Y", "31.02.2024", False),
    ("%Y%m%d", "20240105", True), ("%Y-%m-%dT%H:%M:%S", "2024-01-05T23:59:01", True),
    ("%Y-%m-%d %H:%M:%S.%f", "2024-01-05 23:59:01.5", True), ("%b %d, %Y", "Jan 05, 2024", True), ("%Y-%m-%d", "24-01-05", False), ("%Y%m%d%H%M", "202401051230", True),
    ("%Y%m%d", "2024015", False), ("%H:%M", "7:05", True), ("%Y/%j", "2024/060", True), ("at %Y", "at 2024", True), ("%Y-%m-%d", "", False),
])
def test_strptime_formats(spark, fmt, text, ok):
    parsed = F.try_to_timestamp(F.lit(text), F.lit(D.spark_datetime_pattern(fmt)))
    assert (one(spark, parsed) is not None) is ok


def test_unknown_directive_is_refused():
    with pytest.raises(ValueError):
        D.spark_datetime_pattern("%Q")
