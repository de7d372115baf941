import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from starmart import contracts
from starmart.operators.dedup import keep_last
from starmart.session import scratch_path
from starmart.sources import readers, writers
from starmart.sources.readers import LOAD_ORDER


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_types_and_bad_fields(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "amount,transaction_id,transaction_date,is_fraudulent,extra",  # header order differs, one column is unknown
        "12.345,T1,2024-01-05,true,z",
        "oops,T2,2024-01-05 10:11:12,,z",
        ",T3,not a date,FALSE,z",
    )
    df = readers.read_transactions(spark, path)
    assert df.schema == contracts.TRANSACTIONS_FILE
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["T1"].amount == Decimal("12.35") and rows["T1"].transaction_date == dt.datetime(2024, 1, 5)
    assert rows["T1"].is_fraudulent is True and rows["T3"].is_fraudulent is False and rows["T2"].is_fraudulent is None
    assert rows["T2"].amount is None and rows["T2"].transaction_date == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert rows["T3"].transaction_date is None and rows["T3"].customer_id is None


def test_customer_dates(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,date_of_birth", "C1,1990-2-3", "C2,1990-02-03 00:00:00", "C3,never")
    born = {r.customer_id: r.date_of_birth for r in readers.read_customers(spark, path).collect()}
    assert born == {"C1": dt.date(1990, 2, 3), "C2": dt.date(1990, 2, 3), "C3": None}


@pytest.mark.parametrize("reader, schema", [
    (readers.read_transactions, contracts.TRANSACTIONS_FILE), (readers.read_customers, contracts.CUSTOMERS_FILE),
    (readers.read_products, contracts.PRODUCTS_FILE), (readers.read_branches, contracts.BRANCHES_FILE),
])
def test_missing_and_empty_files_give_empty_tables(spark, tmp_path, reader, schema):
    (tmp_path / "empty.csv").write_text("")
    for path in (tmp_path / "none.csv", tmp_path / "empty.csv"):
        df = reader(spark, str(path))
        assert df.schema == schema and df.count() == 0
        assert reader(spark, str(path), load_order=True).columns[-1] == LOAD_ORDER


def test_other_read_errors_are_not_swallowed(spark):
    with pytest.raises(Exception):
        readers.read_csv(spark, "nosuchscheme://x/y.csv", contracts.CUSTOMERS_FILE).count()


def test_last_row_of_the_last_file_wins(spark, tmp_path):
    write(tmp_path / "1.csv", "product_id,product_name", "P1,old", "P2,only", "P1,newer")
    write(tmp_path / "2.csv", "product_id,product_name", "P1,newest")
    raw = readers.read_products(spark, str(tmp_path), load_order=True)
    last = {r.product_id: r.product_name for r in keep_last(raw, "product_id", LOAD_ORDER).collect()}
    assert last == {"P1": "newest", "P2": "only"}


def test_query_parameters_are_values_not_text(spark):
    df = spark.createDataFrame([("a'b", 1), ("c", 2)], "k string, v int")
    out = readers.read_query(spark, "SELECT v FROM {t} WHERE k = :k", {"k": "a'b"}, t=df)
    assert [r.v for r in out.collect()] == [1]


def test_publish_replaces_and_may_read_itself(spark, database):
    name = f"{database}.numbers"
    assert writers.publish(spark.range(3), name)
    assert writers.publish(spark.table(name).selectExpr("id + 10 AS id"), name)
    assert writers.publish(spark.table(name).where("id > 10"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [11, 12]
    assert writers.table_versions(spark, name) == [2, 3]


def test_publish_skips_empty_results(spark, database):
    name = f"{database}.numbers"
    writers.publish(spark.range(3), name)
    assert not writers.publish(spark.range(0), name, skip_empty=True)
    assert spark.table(name).count() == 3


def test_a_failed_publish_leaves_the_old_contents(spark, database):
    name = f"{database}.numbers"
    writers.publish(spark.range(3), name)
    with pytest.raises(Exception):
        writers.publish(spark.range(3).selectExpr("CAST(concat('x', id) AS BIGINT) AS id"), name)
    assert spark.table(name).count() == 3
    assert writers.publish(spark.range(5), name)
    assert spark.table(name).count() == 5


def test_export_goes_on_after_a_failure(spark, tmp_path):
    def broken():
        raise ValueError("no")

    outcome = writers.export_csv({"bad": broken, "good": spark.range(2)}, str(tmp_path))
    assert outcome == {"bad": "no", "good": None}
    assert sorted(r.id for r in spark.read.option("header", True).csv(str(tmp_path / "good")).collect()) == ["0", "1"]


def test_append_matches_columns_by_name(spark, database):
    spark.sql(f"CREATE TABLE {database}.t (a INT, b STRING) USING parquet")
    writers.append_table(spark.sql("SELECT 'x' AS b, 1 AS a"), f"{database}.t")
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(1, "x")]


def test_views(spark):
    assert writers.register_view(spark.range(4), "v_four").count() == 4
    assert writers.register_view(spark.range(5), "v_four").count() == 5
    assert writers.view_statement("v", "SELECT 1") == "CREATE OR REPLACE VIEW `v` AS SELECT 1"


def test_parquet_round_trip(spark):
    path = scratch_path(spark, "pq")
    writers.write_parquet(spark.range(6).selectExpr("id", "id % 2 AS p"), path, ("p",))
    assert spark.read.parquet(path).count() == 6


def test_scratch_is_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_contract_creates_its_table(spark, database):
    for contract in contracts.WAREHOUSE_TABLES.values():
        table = contract.create(spark, database)
        contract.create(spark, database)
        assert spark.table(table).schema == contract.schema


def test_contract_conform(spark):
    df = spark.sql("SELECT 'C1' AS customer_id, 'x' AS version, '1990-01-01' AS date_of_birth, 5 AS unknown")
    row = contracts.DIM_CUSTOMER.conform(df).first()
    assert (row.customer_id, row.version, row.is_current, row.date_of_birth) == ("C1", 1, True, dt.date(1990, 1, 1))
    assert row.email is None and "unknown" not in row.asDict()


def test_is_missing_source_distinguishes(spark):
    with pytest.raises(AnalysisException) as missing:
        spark.table("no_such_table_here").count()
    assert readers.is_missing_source(missing.value)
    with pytest.raises(AnalysisException) as other:
        spark.range(1).select("nope")
    assert not readers.is_missing_source(other.value)


def test_csv_keeps_hard_text(spark, tmp_path):
    texts = ["  a ", 'He said ""hi"", ok', 'a "quoted", word', "line\nend", "tab\t", "\\ back", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    writers.write_csv(df, f"{tmp_path}/hard")
    back = readers.read_csv(spark, f"{tmp_path}/hard", df.schema, multi_line=True)
    assert {r.id: r.text for r in back.collect()} == dict(enumerate(texts))


def test_csv_quotes_are_doubled(spark, tmp_path):
    (tmp_path / "q.csv").write_text('customer_id,customer_name,city\nC1,"He said ""hi"", ok",Rome\n')
    row = readers.read_customers(spark, f"{tmp_path}/q.csv").first()
    assert (row.customer_name, row.city) == ('He said "hi", ok', "Rome")


def test_csv_headers_count_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,customer_name,city\n1,Bob,Oslo\n")
    (tmp_path / "b.csv").write_text("customer_id,city,customer_name\n2,Rome,Ann\n")
    got = readers.read_customers(spark, f"{tmp_path}/*.csv", load_order=True)
    assert {(r.customer_id, r.customer_name, r.city) for r in got.collect()} == {("1", "Bob", "Oslo"), ("2", "Ann", "Rome")}
