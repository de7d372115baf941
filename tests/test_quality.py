import datetime as dt
from decimal import Decimal

import pytest

from starmart import contracts
from starmart.operators import facts as fact_ops, quality

AT = "2024-05-31 12:00:00"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([
        ("a", 1, "low", "12345", "2024-05-01"), ("b", 5, "odd", "1234", "2024-5-2"), ("b", 9, None, "x12345", "31.12.2023"),
        (None, None, "mad", None, None), (None, 10, "low", "123456", ""),
    ], "id string, n int, risk string, zip string, at string")


def only(results):
    rows = results.collect()
    assert len(rows) == 1
    return rows[0]


def run(df, **checks):
    return quality.run_checks(df, checks, AT)


def test_not_null(df):
    got = {r.columns: (r.passed, r.violations) for r in run(df, not_null={"columns": ["id", "n"]}).collect()}
    assert got == {"id": (False, 2), "n": (False, 1)}


def test_unique_counts_null_as_a_value(df):
    r = only(run(df, unique={"columns": ["id"]}))
    assert (r.passed, r.violations, r.message) == (False, 2, "Column 'id': 2 duplicate(s) found.")
    assert only(run(df, unique={"columns": ["n"]})).passed


def test_unique_is_counted_without_the_lookups_and_in_the_scan_of_the_scalar_checks(spark):
    facts = spark.createDataFrame([("t1", "C1", "P1"), ("t2", "C2", "P9"), ("t2", None, "P1"), (None, "C1", None), (None, "C9", "P1")],
                                  "transaction_id string, customer_id string, product_id string")
    customers = spark.createDataFrame([("C1", 1, True), ("C1", 2, True), ("C2", 3, True)], "customer_id string, customer_sk long, is_current boolean")
    products = spark.createDataFrame([("P1", 1)], "product_id string, product_sk long")
    keyed = fact_ops.lookup_keys(facts, customers, products)  # C1 is there twice: 7 rows, of which 3 have an id of their own
    results = quality.run_checks(keyed, {"unique": {"columns": ["transaction_id", "customer_sk"]}, "not_null": {"columns": ["product_sk"]}})
    assert {(r.check_type, r.columns): r.violations for r in results.collect()} == {
        ("unique", "transaction_id"): 4, ("unique", "customer_sk"): 3, ("not_null", "product_sk"): 3,
    }
    assert quality.run_checks(keyed.limit(0), {"unique": {"columns": ["transaction_id"]}}).first().violations == 0
    one = quality.run_checks(keyed, {"unique": {"columns": ["transaction_id"]}, "not_null": {"columns": ["product_sk"]}})
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


def test_unique_takes_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (map(1, 2)), (map(1, 2)), (map(2, 1)), (NULL) t(m)")
    assert only(run(df, unique={"columns": ["m"]})).violations == 1


def test_values_in_set(df):
    r = only(run(df, values_in_set={"column": "risk", "valid_values": ["low"]}))
    assert (r.passed, r.violations) == (False, 2)
    assert sorted(x.value for x in quality.invalid_values(df, "risk", ["low"]).collect()) == ["mad", "odd"]


@pytest.mark.parametrize("bounds, below, above", [
    ({"min_val": 1, "max_val": 10}, 0, 0), ({"min_val": 2, "max_val": 9}, 1, 1), ({"min_val": 6}, 2, 0), ({"max_val": 4}, 0, 3), ({}, 0, 0),
])
def test_range(df, bounds, below, above):
    r = only(run(df, range={"column": "n", **bounds}))
    assert (r.violations, r.passed) == (below + above, below + above == 0)
    if not below + above:
        assert r.message == "Column 'n': all values in range."
    if below and above:
        assert r.message == "Column 'n': 1 value(s) below 2; 1 value(s) above 9"


def test_regex_is_anchored_at_the_start_only(df):
    assert only(run(df, regex={"column": "zip", "pattern": r"\d{5}"})).violations == 2
    assert only(run(df, regex={"column": "zip", "pattern": r"^\d{5}$"})).violations == 3
    assert only(run(df, regex={"column": "zip", "pattern": r"1|x"})).violations == 0


def test_date_format(df):
    assert only(run(df, date_format={"column": "at"})).violations == 2
    r = only(run(df, date_format={"column": "at", "fmt": "%d.%m.%Y"}))
    assert r.violations == 3 and r.message.endswith("failed to parse with format '%d.%m.%Y'.")


def test_referential_integrity(spark, df):
    parent = spark.createDataFrame([("a",), (None,)], "key string")
    r = only(run(df, referential_integrity={"column": "id", "reference_df": parent, "ref_column": "key"}))
    assert (r.passed, r.violations) == (False, 1)
    assert [x.value for x in quality.first_orphans(df, "id", parent, "key").collect()] == ["b"]
    r = only(run(df, referential_integrity={"column": "id", "reference_df": parent, "ref_column": "nope"}))
    assert r.message == "Column 'nope' does not exist."


def test_first_orphans_are_the_smallest(spark):
    child = spark.range(100).selectExpr("id AS k")
    rows = quality.first_orphans(child, "k", spark.range(3).selectExpr("id AS p"), "p").collect()
    assert [r.value for r in rows] == list(range(3, 23))


@pytest.mark.parametrize("newest, limit, passed, age", [
    (dt.datetime(2024, 5, 1, 12), 30, True, 30), (dt.datetime(2024, 5, 1, 11, 59), 30, False, 30), (dt.datetime(2024, 6, 1), 1, True, -1),
])
def test_freshness(spark, newest, limit, passed, age):
    df = spark.createDataFrame([(newest,), (dt.datetime(2000, 1, 1),), (None,)], "t timestamp_ntz")
    r = only(run(df, freshness={"date_column": "t", "max_age_days": limit}))
    assert (r.passed, r.details["age_days"]) == (passed, str(age))


def test_freshness_without_dates(spark, df):
    r = only(run(df, freshness={"date_column": "risk", "max_age_days": 30}))
    assert (r.passed, r.message) == (False, "Column 'risk' has no parseable dates.")


@pytest.mark.parametrize("check, arguments", [
    ("not_null", {"columns": ["zz"]}), ("unique", {"columns": ["zz"]}), ("values_in_set", {"column": "zz", "valid_values": [1]}),
    ("range", {"column": "zz", "min_val": 0}), ("regex", {"column": "zz", "pattern": "a"}), ("date_format", {"column": "zz"}),
    ("freshness", {"date_column": "zz", "max_age_days": 1}),
])
def test_missing_column_fails(df, check, arguments):
    r = only(quality.run_checks(df, {check: arguments}, AT))
    assert (r.check_type, r.columns, r.passed, r.message) == (check, "zz", False, "Column 'zz' does not exist.")


def test_unknown_checks_are_skipped_and_broken_ones_fail(df):
    assert run(df, strange={"column": "id"}).count() == 0
    for broken in ({"regex": {"column": "zip", "pattern": "("}}, {"range": {"column": "id", "min_val": 1}}, {"unique": {"cols": ["id"]}}):
        r = only(quality.run_checks(df, {**broken}, AT))
        assert (r.passed, r.message) == (False, "Check raised an exception.")


def test_summary_and_gate(df):
    results = run(df, not_null={"columns": ["id"]}, range={"column": "n", "min_val": 0}, values_in_set={"column": "risk", "valid_values": ["low"]})
    assert tuple(quality.summarize(results).first()) == (3, 1, 2)
    with pytest.raises(quality.QualityGateError, match="2 data quality"):
        quality.enforce(results)
    quality.enforce(run(df, range={"column": "n", "min_val": 0}))


def test_scalar_checks_share_one_scan(df):
    results = run(df, not_null={"columns": ["id", "n", "risk"]}, range={"column": "n", "min_val": 0}, regex={"column": "zip", "pattern": "a"})
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_table_rules(spark, df):
    rules = {
        "known": {"not_null": ["id", "no_such_column"], "unique": ["id"], "range": {"n": [0, 5], "zz": [0, 1]}, "where": "risk = 'low'"},
        "no_such_table_at_all": {"not_null": ["x"]},
    }
    got = {(r.table_name, r.check_type, r.columns): (r.passed, r.violations) for r in quality.run_table_rules(spark, rules, {"known": df}).collect()}
    assert got == {
        ("known", "not_null", "id"): (False, 1), ("known", "unique", "id"): (True, 0), ("known", "range", "n"): (False, 1),
        ("no_such_table_at_all", "readable", ""): (False, None),
    }
    assert quality.run_table_rules(spark, {}).count() == 0


def test_contract_rules_find_violations(spark):
    facts = contracts.FACT_TRANSACTIONS.conform(spark.createDataFrame(
        [(1, "a", 20240101, 1, 1, Decimal(1)), (1, "b", 20240102, None, 2, Decimal(1))],
        "transaction_sk long, transaction_id string, date_key int, customer_sk long, product_sk long, amount decimal(15,2)",
    ))
    dims = {
        "dim_date": spark.sql("SELECT 20240101 AS date_key"), "dim_customer": spark.sql("SELECT 1L AS customer_sk"),
        "dim_product": spark.sql("SELECT 1L AS product_sk"), "dim_branch": spark.sql("SELECT 1L AS branch_sk"),
    }
    results = quality.run_table_rules(spark, {"fact_transactions": contracts.FACT_TRANSACTIONS.rules()}, {"fact_transactions": facts, **dims})
    failed = {(r.check_type, r.columns): r.violations for r in results.where("NOT passed").collect()}
    assert failed == {
        ("not_null", "customer_sk"): 1, ("unique", "transaction_sk"): 1, ("referential_integrity", "date_key"): 1,
        ("referential_integrity", "product_sk"): 1,
    }


def test_one_unusable_check_leaves_the_others(spark):
    df = spark.sql("SELECT * FROM VALUES ('x'), ('y'), (NULL) t(v)")
    checks = {
        "not_null": {"columns": ["v"]}, "regex": {"column": "v", "pattern": r"(?P<y>\d{4})"},
        "values_in_set": [{"column": "v", "valid_values": ["x", None]}, {"column": "v", "valid_values": [1, 2]}],
    }
    got = [(r.check_type, r.passed, r.violations) for r in quality.run_checks(df, checks).orderBy("check_type", "violations").collect()]
    assert got == [("not_null", False, 1), ("regex", False, None), ("values_in_set", False, 1), ("values_in_set", False, 2)]
    values = {(r.columns, r.value) for r in quality.offending_values(df, {"values_in_set": checks["values_in_set"][0]}).collect()}
    assert values == {("v", "y")}


def test_long_sets_are_looked_up_by_hash(spark):
    df = spark.sql("SELECT CAST(id AS INT) AS n, CAST(id % 7 AS DOUBLE) / (id % 7 - 3) AS x FROM range(100) WHERE id % 7 <> 3")
    found = quality.invalid_values(df, "n", [*range(0, 5000, 2), None, "no number"])
    assert sorted(r.value for r in found.collect()) == [n for n in range(1, 100, 2) if n % 7 != 3]
    assert "INSET" in found._jdf.queryExecution().optimizedPlan().toString()
    assert quality.invalid_values(df, "n", []).count() == df.count() and quality.invalid_values(df, "n", [None]).count() == df.count()
