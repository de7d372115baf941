import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart.operators import scd2
from starmart.operators.quality import QualityGateError
from starmart.plans.warehouse import DEFAULT_CONFIG, Warehouse
from starmart.session import FREE_SHUFFLES_CONF, scratch_root, shuffles_freed, staged
from starmart.streaming.incremental import load_stream, transaction_stream

AS_OF = "2024-05-01 10:00:00"
CONFIG = {**DEFAULT_CONFIG, "date_range_start": "2024-01-01", "date_range_end": "2024-12-31"}


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def warehouse(spark, tmp_path):
    name = f"w_{uuid.uuid4().hex[:8]}"
    yield Warehouse(spark, name, f"{tmp_path}/db", "2024-05-01 10:00:00", CONFIG).create()
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def files(tmp_path):
    return {
        "transactions": write(tmp_path / "t.csv", "transaction_id,customer_id,product_id,transaction_date,amount,channel",
                              "T1,C1,P1,2024-03-01,10.00,ATM", "T2,C2,P1,2024-04-01,20.00,POS", "T3,C9,P1,2024-04-01,1.00,POS",
                              "T4,C1,,2024-04-01,1.00,POS"),
        "customers": write(tmp_path / "c.csv", "customer_id,customer_name,city", "C1,Ann,X", "C2,Bob,X", "C1,Ann,Y"),
        "products": write(tmp_path / "p.csv", "product_id,product_name,product_category", "P1,old,Card", "P1,new,Card"),
    }


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_full_and_incremental_load(warehouse, files, tmp_path):
    counts = warehouse.full_load(files["transactions"], files["customers"], files["products"])
    assert counts == {"rows_in": 4, "null_required": 1, "invalid_date": 0, "missing_customer": 1, "missing_product": 0, "rows_out": 2}
    assert rows(warehouse.table("dim_product"), "product_id", "product_name", "is_active") == [("P1", "new", True)]
    assert rows(warehouse.table("dim_customer"), "customer_id", "city", "version") == [("C1", "Y", 1), ("C2", "X", 1)]
    assert warehouse.table("dim_date").count() == 366
    first = rows(warehouse.table("fact_transactions"), "transaction_id", "transaction_sk", "date_month")

    later = write(tmp_path / "t2.csv", "transaction_id,customer_id,product_id,transaction_date,amount",
                  "T2,C2,P1,2024-04-01,99.00", "T5,C2,P1,2024-04-02,5.00", "T6,C3,P1,2024-04-02,6.00")
    moved = write(tmp_path / "c2.csv", "customer_id,customer_name,city", "C2,Bob,Z", "C3,Cy,X")
    for _ in range(2):  # the repetition adds nothing
        warehouse.incremental_load(later, moved)
        got = rows(warehouse.table("fact_transactions"), "transaction_id", "transaction_sk", "date_month")
        assert set(first) < set(got) and [g[0] for g in got] == ["T1", "T2", "T5", "T6"]
        assert sorted(g[1] for g in got) == [1, 2, 3, 4]
        assert rows(warehouse.table("dim_customer"), "customer_id", "city", "version", "is_current") == [
            ("C1", "Y", 1, True), ("C2", "X", 1, False), ("C2", "Z", 2, True), ("C3", "X", 1, True)]
    bound = warehouse.table("fact_transactions").join(warehouse.table("dim_customer"), "customer_sk")
    assert rows(bound, "transaction_id", "city") == [("T1", "Y"), ("T2", "X"), ("T5", "Z"), ("T6", "X")]
    assert warehouse.table("fact_transactions").where("transaction_id = 'T2'").first().amount == 20


def test_final_dates_prune_the_stored_months(warehouse, files):
    warehouse.full_load(files["transactions"], files["customers"], files["products"])
    warehouse.dates_are_final = True
    warehouse.incremental_load(files["transactions"], files["customers"])
    assert warehouse.table("fact_transactions").count() == 2


def test_copies_inside_a_batch_get_keys_of_their_own(spark, warehouse, files):
    """Copies of one id are all kept, as ids are compared with stored rows only; the option keeps one."""
    warehouse.full_load(files["transactions"], files["customers"], files["products"])
    batch = warehouse.table("fact_transactions").where("transaction_id = 'T1'").drop("transaction_sk").withColumn(
        "transaction_id", F.lit("T50")).join(spark.range(200).select(F.lit("T50").alias("transaction_id")), "transaction_id")
    warehouse.load_facts(batch.withColumn("transaction_id", F.lit("T60")), dedup_batch=True)
    warehouse.load_facts(batch)
    warehouse.load_facts(batch)
    facts = warehouse.table("fact_transactions")
    assert facts.count() == facts.select("transaction_sk").distinct().count() == 2 + 1 + 200


def test_missing_files_load_nothing(warehouse, tmp_path):
    none = str(tmp_path / "none.csv")
    counts = warehouse.full_load(none, none, none)
    assert counts["rows_in"] == 0 and warehouse.table("fact_transactions").count() == 0


def source(spark, segment="Basic", amount="10.00"):
    from starmart.operators.calendar import calendar_full, days_between

    return {
        "dim_date": calendar_full(days_between(spark, "2024-01-01", "2024-12-31")),
        "dim_branch": spark.sql("SELECT 'B1' AS branch_id, 'b' AS branch_name, 'c' AS city, 's' AS state, 'r' AS region"),
        "dim_product": spark.sql("SELECT 'P1' AS product_id, 'card' AS product_name, 'Card' AS product_category"),
        "dim_customer": spark.sql(f"""SELECT 'C1' AS customer_id, 'Ann' AS customer_name, 'a@x' AS email, 'Female' AS gender,
                                      '{segment}' AS customer_segment, 'X' AS city"""),
        "transactions": spark.sql(f"""SELECT 'T1' AS transaction_id, 'C1' AS customer_id, 'P1' AS product_id, 'B1' AS branch_id,
                                      DATE'2024-04-20' AS transaction_date, CAST({amount} AS DECIMAL(15,2)) AS amount, 'ATM' AS channel"""),
    }


def test_end_to_end(spark, warehouse, tmp_path):
    batch = spark.sql("SELECT 'C1' AS customer_id, 'Ann' AS customer_name, 'a@x' AS email, 'Premium' AS customer_segment, 'X' AS city")
    outcome = warehouse.run(source(spark), f"{tmp_path}/out", batch)
    assert set(outcome) == {"v_churn_risk", "v_cross_sell_affinity", "v_monthly_revenue", "dim_customer", "dim_product", "dim_date", "dim_branch"}
    assert all(error is None for error in outcome.values())
    history = rows(warehouse.table("dim_customer"), "version", "customer_segment", "gender", "effective_date", "expiry_date")
    day = dt.date(2024, 5, 1)
    assert history == [(1, "Basic", "Female", day, day), (2, "Premium", "Female", dt.date(2024, 5, 2), None)]
    risk = warehouse.table("v_churn_risk").first()
    assert (risk.total_transactions, risk.churn_status) == (0, "Active")  # history stays with the old version
    exported = spark.read.option("header", True).csv(f"{tmp_path}/out/v_monthly_revenue").first()
    assert (exported.year, exported.month, exported.total_amount) == ("2024", "4", "10.00")
    assert rows(warehouse.table("fact_transactions"), "fee", "is_fraudulent") == [(0, False)]


def test_initial_load_twice_adds_nothing(spark, warehouse):
    for _ in range(2):
        warehouse.initial_load(source(spark))
    for table in ("dim_customer", "dim_product", "dim_branch", "fact_transactions"):
        assert warehouse.table(table).count() == 1


def test_gate_stops_before_customer_changes(spark, warehouse, tmp_path):
    with pytest.raises(QualityGateError, match="customer_segment"):
        warehouse.run(source(spark, segment="Gold"), f"{tmp_path}/out", source(spark)["dim_customer"])
    assert warehouse.table("dim_customer").count() == 1
    failed = warehouse.table("quality_results").where("NOT passed")
    assert [r.check_type for r in failed.collect()] == ["values_in_set"]
    assert not (tmp_path / "out").exists()


def test_views_change_nothing(spark, warehouse):
    warehouse.initial_load(source(spark))
    before = rows(warehouse.table("dim_customer"), "customer_sk", "version")
    for _ in range(2):
        assert warehouse.create_views()["v_churn_risk"].count() == 1
    assert rows(warehouse.table("dim_customer"), "customer_sk", "version") == before


def test_stored_views_equal_the_data_frames(spark, warehouse):
    warehouse.initial_load(source(spark))
    stored = warehouse.create_views()
    for name, df in warehouse.views().items():
        assert stored[name].columns == df.columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, df.collect()))


def test_missing_keys_are_rejected_once(spark, warehouse):
    data = source(spark)
    nobody = data["dim_customer"].withColumn("customer_id", F.lit(None).cast("string"))
    nothing = data["dim_product"].withColumn("product_id", F.lit(None).cast("string"))
    for _ in range(2):
        warehouse.load_customers(data["dim_customer"].unionByName(nobody))
        warehouse.load_products(data["dim_product"].unionByName(nothing))
    assert warehouse.table("dim_customer").where("customer_id IS NULL").isEmpty() and warehouse.table("dim_product").where("product_id IS NULL").isEmpty()
    assert {(r.table_name, r.columns) for r in warehouse.table("rejected_rows").collect()} == {("dim_customer", "customer_id"), ("dim_product", "product_id")}
    assert warehouse.table("rejected_rows").count() == nobody.distinct().count() + nothing.distinct().count()


def test_strict_loads_reject_broken_rows(spark, warehouse):
    warehouse.strict = True
    data = source(spark)
    data["transactions"] = data["transactions"].withColumn("amount", F.lit("not-a-number"))
    warehouse.initial_load(data)
    assert warehouse.table("fact_transactions").isEmpty()
    assert "amount" in warehouse.table("rejected_rows").where("table_name = 'fact_transactions'").first().columns


def test_snapshot_is_loaded_once(spark, warehouse):
    warehouse.initial_load(source(spark))
    for _ in range(2):
        warehouse.load_snapshot("2024-04-30")
    stored = warehouse.table("fact_customer_snapshot").collect()
    assert [(r.snapshot_sk, r.date_key, r.total_transactions) for r in stored] == [(1, 20240430, 1)]


def test_materialize_all(spark, warehouse):
    warehouse.initial_load(source(spark))
    written = warehouse.materialize()
    assert len(written) == 6 and all(spark.table(t).count() >= 1 for t in written)


def test_no_tracked_columns_is_a_no_op(spark, warehouse):
    warehouse.initial_load(source(spark))
    warehouse.config = {**CONFIG, "scd_type2": {"tracked_columns": []}}
    warehouse.apply_customer_batch(source(spark, segment="Premium")["dim_customer"])
    assert warehouse.table("dim_customer").count() == 1


def test_stream_loads_each_file_once(spark, warehouse, files, tmp_path):
    warehouse.full_load(files["transactions"], files["customers"], files["products"])
    folder = tmp_path / "arrivals"
    folder.mkdir()
    header = ("transaction_id,customer_id,product_id,branch_id,transaction_date,amount,fee,balance_after,transaction_type,"
              "transaction_category,channel,status,merchant,merchant_category,created_at,is_fraudulent")
    write(folder / "1.csv", header, "T1,C1,P1,,2024-03-01,10.00,,,,,,,,,,", "T7,C1,P1,,2024-03-02,7.00,,,,,,,,,,true")
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):
        load_stream(warehouse, transaction_stream(spark, str(folder)), checkpoint).awaitTermination()
    write(folder / "2.csv", header, "T7,C1,P1,,2024-03-02,7.00,,,,,,,,,,true", "T8,C2,P1,,2024-03-02,8.00,,,,,,,,,,")
    load_stream(warehouse, transaction_stream(spark, str(folder)), checkpoint).awaitTermination()
    assert rows(warehouse.table("fact_transactions"), "transaction_id", "is_fraudulent") == [
        ("T1", False), ("T2", False), ("T7", True), ("T8", False)]


def batch_of(spark, *ids, city="Q"):
    return spark.createDataFrame([(i, f"n{i}", city) for i in ids], "customer_id string, customer_name string, city string")


def stored_files(warehouse):
    return set(warehouse.table("dim_customer").inputFiles())


def test_a_small_batch_rewrites_its_buckets_only(spark, database, tmp_path):
    warehouse = Warehouse(spark, database, as_of=AS_OF, customer_buckets=16).create()
    everybody = [f"C{i}" for i in range(400)]
    warehouse.load_customers(batch_of(spark, *everybody))
    before = stored_files(warehouse)
    assert len(before) >= 16
    warehouse.load_customers(batch_of(spark, "C1", "C2", "N1", city="Z"))
    after = stored_files(warehouse)
    assert len(after & before) >= len(before) - 3 and 1 <= len(after - before) <= 3
    dim = warehouse.table("dim_customer")
    assert dim.count() == 403 and dim.where("is_current").count() == 401
    assert dim.select("customer_sk").distinct().count() == 403 and dim.agg(F.max("customer_sk")).first()[0] == 403
    assert scd2.history_violations(dim).isEmpty()
    assert rows(dim.where("customer_id = 'C1'"), "version", "city", "is_current") == [(1, "Q", False), (2, "Z", True)]
    warehouse.load_customers(batch_of(spark, "C1", city="Z"))  # nothing is new
    assert stored_files(warehouse) == after


def test_old_files_go_when_no_kept_version_refers_to_them(spark, database, tmp_path):
    warehouse = Warehouse(spark, database, as_of=AS_OF, customer_buckets=4).create()
    seen = []
    for i in range(5):
        warehouse.load_customers(batch_of(spark, *[f"C{j}" for j in range(40)], city=f"c{i}"))
        seen.append(stored_files(warehouse))
    exists = lambda files: [Path(f.removeprefix("file:").replace("///", "/")).exists() for f in files]
    assert all(exists(seen[-1])) and all(exists(seen[-2])) and not any(exists(seen[0] | seen[1] | seen[2]))
    assert warehouse.table("dim_customer").count() == 200


def test_a_load_that_is_cut_off_leaves_the_old_customers(spark, database, monkeypatch):
    warehouse = Warehouse(spark, database, as_of=AS_OF, customer_buckets=4).create()
    warehouse.load_customers(batch_of(spark, *[f"C{j}" for j in range(40)]))
    before, plain = rows(warehouse.table("dim_customer"), "customer_sk", "customer_id", "version"), type(spark).sql

    def cut_off(self, text, *rest, **more):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("lost")
        return plain(self, text, *rest, **more)

    monkeypatch.setattr(type(spark), "sql", cut_off)
    with pytest.raises(RuntimeError, match="lost"):
        warehouse.load_customers(batch_of(spark, "C1", "N1", city="Z"))
    monkeypatch.undo()
    assert rows(warehouse.table("dim_customer"), "customer_sk", "customer_id", "version") == before
    warehouse.load_customers(batch_of(spark, "C1", "N1", city="Z"))
    assert warehouse.table("dim_customer").count() == 42
    assert len([t for t in spark.catalog.listTables(database) if t.name.startswith("dim_customer__")]) == 2


def test_counts_with_an_empty_dimension(spark, database, tmp_path):
    """Without customers no fact can be left, and the rows are counted all the same."""
    warehouse = Warehouse(spark, database, as_of=AS_OF).create()
    raw = spark.sql("SELECT 'T1' transaction_id, 'C1' customer_id, 'P1' product_id, 5 amount, DATE'2024-01-01' transaction_date, 'ATM' channel")
    counts = warehouse.load_transactions(raw)
    assert counts["rows_in"] == 1 and counts["rows_out"] == 0 and counts["missing_customer"] == 1


def test_facts_bind_to_the_version_of_their_day(spark, database):
    warehouse = Warehouse(spark, database, as_of="2024-03-01", bind_as_of=True, customer_buckets=2).create()
    products = spark.sql("SELECT 'P1' product_id, 'x' product_name")
    warehouse.load_products(products)
    warehouse.load_customers(batch_of(spark, "C1", city="old"))
    warehouse.as_of = "2024-06-01"
    warehouse.load_customers(batch_of(spark, "C1", city="new"))
    raw = spark.sql("""SELECT * FROM VALUES ('T0', 'C1', DATE'2023-01-01'), ('T1', 'C1', DATE'2024-05-31'), ('T2', 'C1', DATE'2024-06-01'),
        ('T3', 'C9', DATE'2024-06-01') t(transaction_id, customer_id, transaction_date)""").selectExpr("*", "'P1' product_id", "5 amount", "'ATM' channel")
    counts = warehouse.load_transactions(raw)
    assert counts["rows_out"] == 3 and counts["missing_customer"] == 1
    bound = warehouse.table("fact_transactions").join(warehouse.table("dim_customer"), "customer_sk")
    assert rows(bound, "transaction_id", "city") == [("T0", "old"), ("T1", "old"), ("T2", "new")]


def test_new_facts_are_written_once_before_they_are_appended(spark, warehouse, files, monkeypatch):
    """Facts of which none is stored get their keys in the copy they already have, and facts that are all stored none;
    rows that fall out, be it for want of an id, leave no gap in the keys."""
    from starmart.operators import keys

    copies = []
    plain = keys.staged
    monkeypatch.setattr(keys, "staged", lambda df, label: copies.append("transaction_id" in df.columns) or plain(df, label))
    warehouse.full_load(files["transactions"], files["customers"], files["products"])
    first = warehouse.table("fact_transactions").drop("transaction_sk", "date_month")
    batch = spark.createDataFrame(first.collect(), first.schema)
    warehouse.load_facts(batch.withColumn("transaction_id", F.concat("transaction_id", F.lit("new"))))
    warehouse.load_facts(batch)
    assert not any(copies)
    some = F.when(F.col("transaction_id") == "T1", F.lit(None).cast("string")).otherwise(F.concat("transaction_id", F.lit("last")))
    warehouse.load_facts(batch.withColumn("transaction_id", some))
    warehouse.load_facts(batch.withColumn("transaction_id", F.regexp_replace("transaction_id", "T1", "T10")))
    got = rows(warehouse.table("fact_transactions"), "transaction_sk", "transaction_id")
    assert [k for k, _ in got] == [1, 2, 3, 4, 5, 6]
    assert sorted(i for _, i in got) == ["T1", "T10", "T1new", "T2", "T2last", "T2new"]
    assert warehouse.table("rejected_rows").where("table_name = 'fact_transactions'").count() == 1


@pytest.fixture
def copies(spark):
    """The copies that a test leaves in the scratch folder, as their columns."""
    def named():
        root = Path(scratch_root(spark).removeprefix("file:"))
        return set(root.iterdir()) if root.exists() else set()

    before = named()
    return lambda: [set(spark.read.parquet(str(p)).columns) for p in named() - before]


def test_copies_of_a_batch_go_with_the_load(spark, warehouse, files, copies, tmp_path):
    """The written copies of the facts are deleted, also where rows fall out and are written again, and where the load fails."""
    warehouse.full_load(files["transactions"], files["customers"], files["products"])
    later = write(tmp_path / "t2.csv", "transaction_id,customer_id,product_id,transaction_date,amount",
                  "T2,C2,P1,2024-04-01,99.00", "T5,C2,P1,2024-04-02,5.00")
    for _ in range(2):  # the second time all are stored
        warehouse.incremental_load(later, files["customers"])
    assert rows(warehouse.table("fact_transactions"), "transaction_id") == [("T1",), ("T2",), ("T5",)]
    bad = warehouse.table("fact_transactions").withColumn("transaction_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        warehouse.load_facts(bad)
    assert not [columns for columns in copies() if "transaction_id" in columns]


def test_shuffle_files_go_when_a_write_ends(spark, tmp_path):
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    rows_of = lambda: spark.range(10_000).repartition(7, "id")
    before = held()
    copy = staged(rows_of(), "x")
    assert copy.count() == 10_000 and spark.conf.get(FREE_SHUFFLES_CONF) == "false"
    freed = held()
    rows_of().write.parquet(f"{tmp_path}/kept")
    assert held() - freed > freed - before
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
        assert spark.conf.get(FREE_SHUFFLES_CONF) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(FREE_SHUFFLES_CONF) == "false"


def test_keys_of_a_batch_are_counted_once_and_not_written(spark, warehouse, copies):
    """All stored, none stored, some stored: the stored keys are not copied."""
    facts = lambda *ids: spark.createDataFrame([(i, 20240401, 1, 1) for i in ids], "transaction_id string, date_key int, customer_sk long, product_sk long")
    for batch in (("a", "b", "b"), ("c",), ("a", "b"), ("c", "d", "d"), ("d",)):
        warehouse.load_facts(facts(*batch))
    got = rows(warehouse.table("fact_transactions"), "transaction_id", "transaction_sk")
    assert [g[0] for g in got] == ["a", "b", "b", "c", "d", "d"] and sorted(g[1] for g in got) == [1, 2, 3, 4, 5, 6]
    assert copies() == []
