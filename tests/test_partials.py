"""Feature tables kept from monthly aggregates against those worked out from all facts."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from starmart.operators import calendar
from starmart.plans import partials, registry
from starmart.plans.warehouse import Warehouse
from starmart.sources.writers import publish_buckets

AS_OF = "2024-05-01 10:00:00"


def facts(spark, low, high):
    """Transactions of 40 customers and 7 products over 15 months; some of unknown customers, on unusable days, without amount or category."""
    return spark.range(low, high).selectExpr(
        "concat('T', id) AS transaction_id",
        """CASE WHEN id % 97 = 0 THEN 20239999 WHEN id % 101 = 0 THEN NULL
           ELSE CAST(date_format(date_add(DATE'2023-03-03', CAST(id * 7919 % 440 AS INT)), 'yyyyMMdd') AS INT) END AS date_key""",
        "CASE WHEN id % 31 > 0 THEN CASE WHEN id % 3 = 0 THEN 1 ELSE id * 31 % 40 END END AS customer_sk", "id * 13 % 7 AS product_sk",
        "CASE WHEN id % 11 > 0 THEN CAST(id * 37 % 1000 / 10 - 20 AS DECIMAL(15,2)) END AS amount",
        "CASE WHEN id % 5 > 0 THEN CAST(id % 777 AS DECIMAL(15,2)) END AS balance_after",
        "element_at(array('Credit', 'Debit', 'Transfer'), CAST(id % 3 + 1 AS INT)) AS transaction_type",
        "CASE WHEN id % 9 > 0 THEN element_at(array('Purchase', 'Fee'), CAST(id % 2 + 1 AS INT)) END AS transaction_category",
        "element_at(array('Online', 'ATM', 'POS', 'Branch'), CAST(id % 4 + 1 AS INT)) AS channel",
        "'m' AS merchant", "'k' AS merchant_category", "TIMESTAMP'2024-01-01 10:00:00' AS created_at", "id % 50 = 0 AS is_fraudulent",
    )


@pytest.fixture
def warehouse(spark, tmp_path):
    name = f"p_{uuid.uuid4().hex[:8]}"
    w = Warehouse(spark, name, f"{tmp_path}/db", AS_OF).create()
    w.load_dates(calendar.calendar_full(calendar.days_between(spark, "2023-01-01", "2024-04-10")))
    w.load_products(spark.sql("SELECT concat('P', id) AS product_id, 'n' AS product_name, concat('c', id % 3) AS product_category FROM range(7)"))
    customers = spark.sql("""SELECT id AS customer_sk, concat('C', id) AS customer_id, 'High' AS income_bracket, 'Basic' AS customer_segment,
        concat('s', id % 4) AS state, concat('t', id % 8) AS city, DATE'2001-01-01' AS account_open_date, DATE'1980-02-03' AS date_of_birth,
        DATE'2020-01-01' AS effective_date, id <> 39 AS is_current, 1 AS version FROM range(45)""")
    stored = w.table("dim_customer").schema
    columns = [(F.col(f.name) if f.name in customers.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored.fields]
    publish_buckets(customers.select(columns), w.name("dim_customer"), "customer_id")
    yield w
    spark.sql(f"DROP DATABASE {name} CASCADE")


def check_against_all_facts(w):
    star = w.star()
    names = w.materialize(incremental=True)
    assert [n.split(".")[1] for n in names] == list(registry.FEATURE_TABLES)
    for name, build in registry.FEATURE_TABLES.items():
        got, want = w.table(name), build(star, AS_OF)
        assert got.schema.simpleString() == want.schema.simpleString()
        pair = [sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[:3])) for df in (got, want)]
        assert len(pair[0]) == len(pair[1]) > 0
        if name == "vw_fraud_detection_features":
            continue
        for a, b in zip(*pair, strict=True):
            for x, y in zip(a, b, strict=True):
                assert x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6), (name, a, b)


def test_tables_equal_a_full_build_after_each_load(spark, warehouse):
    w = warehouse
    w.load_facts(facts(spark, 0, 2000))
    check_against_all_facts(w)
    undated = partials.refresh(w.star(), w.database)
    # months with days that the calendar does not have are read until it has them; all others are done
    assert undated == {"month_customer_product": [0, 202399, 202404, 202405], "month_spend": []}

    more = facts(spark, 2000, 2600).where("date_key BETWEEN 20230801 AND 20230930")
    w.load_facts(more.withColumn("customer_sk", F.coalesce("customer_sk", F.lit(44))))  # a customer without facts so far
    read = w.star()
    assert partials.refresh(read, w.database)["month_spend"] == [202308, 202309]
    check_against_all_facts(w)

    w.load_dates(calendar.calendar_full(calendar.days_between(spark, "2024-01-01", "2024-12-31")))
    check_against_all_facts(w)
    assert partials.refresh(w.star(), w.database)["month_customer_product"] == [0, 202399]


def test_only_changed_months_are_read(spark, warehouse):
    w = warehouse
    w.load_facts(facts(spark, 0, 2000))
    star = w.star()
    for build in partials.STATES.values():
        files = build(star.facts, star.dates, [202308, 202309]).inputFiles()
        months = {f.split("date_month=")[1][:6] for f in files if "date_month=" in f}
        assert months == {"202308", "202309"}
    partials.refresh(star, w.database)
    late = partials.churn_features(star, partials.month_states(star, w.database), AS_OF).inputFiles()
    assert {f.split("date_month=")[1][:6] for f in late if "date_month=" in f} == {"202402", "202403", "202404", "202405", "202399"} - {"202399"}


def test_months_are_counted_without_reading_columns(spark, warehouse):
    w = warehouse
    w.load_facts(facts(spark, 0, 100))
    held = w.star().facts.groupBy(partials.month_of().alias("month")).count()
    text = held._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in text


def test_a_cut_off_refresh_is_made_up_for(spark, warehouse, monkeypatch):
    w = warehouse
    w.load_facts(facts(spark, 0, 500))
    partials.refresh(w.star(), w.database)
    w.load_facts(facts(spark, 500, 700))
    before = w.table("month_spend").count()

    def lost(*_args, **_options):
        raise RuntimeError("lost")

    monkeypatch.setattr(partials, "publish_buckets", lost)
    with pytest.raises(RuntimeError):
        partials.refresh(w.star(), w.database)
    assert w.table("month_spend").count() == before
    monkeypatch.undo()
    check_against_all_facts(w)


def test_no_facts(warehouse):
    assert partials.refresh(warehouse.star(), warehouse.database) == {"month_customer_product": [], "month_spend": []}
    states = partials.month_states(warehouse.star(), warehouse.database)
    assert partials.customer_features(warehouse.star(), states, AS_OF).count() == 44
    assert partials.regional_analysis(warehouse.star(), states, AS_OF).count() == 0
