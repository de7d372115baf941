"""One query per operator, each over whole given tables. Keys match :mod:`checks.oracle`."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.fixtures import (
    AS_OF, CATEGORIES, CHANNELS, EVENTS_AS_OF, PRODUCT_CATEGORIES, Star,
)
from starmart import contracts
from starmart.functions import columns as C, dates as D
from starmart.operators import baskets, calendar, dedup, facts as fact_ops, ordered, quality, scd2
from starmart.operators.keys import assign_surrogate_keys
from starmart.plans import churn, cross_sell, customer, fraud, performance, revenue
from starmart.plans.registry import StarTables, materialize_all
from starmart.plans.warehouse import DEFAULT_CONFIG, Warehouse
from starmart.session import scratch_path, staged
from starmart.sources import readers, writers
from starmart.streaming.incremental import load_stream, transaction_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register ``build`` under its own name, with plain result types."""
    QUERIES[build.__name__] = lambda spark, folder: tidy(build(Star(spark, folder)))
    return build


#: Doubles that come from exact inputs by the same arithmetic in any engine; all others are rounded to 4 places.
EXACT = {
    "avg_transaction_amount", "avg_balance", "mean", "avg_balance_last_30d", "avg_balance_prev_30d", "time_since_last_tx",
    "mean_amount",
}


def tidy(df: DataFrame) -> DataFrame:
    """Types that any engine has: decimals as doubles, arrays as text, timestamps without a zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType) and f.name not in EXACT:
            c = F.round(c, 4)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch_database(spark: SparkSession) -> tuple[str, str]:
    name = f"starmart_{uuid.uuid4().hex[:10]}"
    return name, scratch_path(spark, name)


def csv_copy(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    writers.write_csv(df, path, "gzip")
    return path


# --- sources ----------------------------------------------------------------------------------------------

@query
def src_transactions_csv(s: Star) -> DataFrame:
    rows = readers.read_transactions(s.spark, csv_copy(s.raw_transactions, "transactions"))
    return rows.select("transaction_id", "customer_id", "product_id", "transaction_date", "amount", "is_fraudulent")


@query
def src_customers_csv(s: Star) -> DataFrame:
    attributes = s.customers.select("customer_id", *contracts.CUSTOMER_ATTRIBUTES)
    return readers.read_customers(s.spark, csv_copy(attributes, "customers"))


@query
def src_products_csv(s: Star) -> DataFrame:
    return readers.read_products(s.spark, csv_copy(s.products.drop("product_sk"), "products"))


@query
def src_missing_is_empty(s: Star) -> DataFrame:
    missing = readers.read_transactions(s.spark, scratch_path(s.spark, "missing"))
    present = readers.read_transactions(s.spark, csv_copy(s.raw_transactions, "transactions"))
    return missing.unionByName(present).groupBy(F.to_date("transaction_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query
def src_param_query(s: Star) -> DataFrame:
    return readers.read_query(
        s.spark,
        "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {orders} "
        "WHERE o_orderdate >= :since AND o_totalprice > :floor GROUP BY o_orderpriority",
        {"since": "1998-01-01", "floor": 1000.0},
        orders=s.raw("orders"),
    )


def _hard_text(s: Star) -> DataFrame:
    """All document texts, with quotes, line ends and outer blanks added."""
    return s.raw("documents").select("doc_id", F.concat(F.lit('  "'), "text", F.lit('" ,""\n x ')).alias("text"))


@query
def src_csv_quoted_text(s: Star) -> DataFrame:
    """Customers whose names hold quotes, commas and outer blanks."""
    names = s.raw("documents").select(
        F.col("doc_id").cast("string").alias("customer_id"),
        F.concat(F.lit(' "'), F.translate("text", "\n\r", "  "), F.lit('", ')).alias("customer_name"),
    )
    back = readers.read_customers(s.spark, csv_copy(names, "quoted"))
    return back.select("customer_id", F.md5("customer_name").alias("name"))


@query
def src_csv_mixed_headers(s: Star) -> DataFrame:
    """Two files with the same columns in another order."""
    docs = s.raw("documents").select("doc_id", "lang", "source")
    here = csv_copy(docs.where("doc_id % 2 = 0"), "here")
    there = csv_copy(docs.where("doc_id % 2 = 1").select("source", "doc_id", "lang"), "there")
    return readers.read_csv(s.spark, [here, there], docs.schema)


@query
def sink_csv_text_roundtrip(s: Star) -> DataFrame:
    texts = _hard_text(s)
    back = readers.read_csv(s.spark, csv_copy(texts, "texts"), texts.schema, multi_line=True)
    return back.select("doc_id", F.md5("text").alias("text"))


# --- sinks and contracts ----------------------------------------------------------------------------------

@query
def sink_materialize_roundtrip(s: Star) -> DataFrame:
    database, place = scratch_database(s.spark)
    s.spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    table = f"{database}.revenue"
    writers.publish(revenue.monthly_revenue(s.facts, s.dates, s.products), table)
    writers.publish(s.spark.read.table(table), table)  # replaced by a read of itself
    return s.spark.read.table(table)


@query
def sink_csv_roundtrip(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "export")
    result = revenue.monthly_revenue(s.facts, s.dates, s.products)
    writers.export_csv({"v_monthly_revenue": result}, folder)
    return readers.read_csv(s.spark, f"{folder}/v_monthly_revenue", result.schema)


@query
def view_registered(s: Star) -> DataFrame:
    return writers.register_view(performance.regional_analysis(s.facts, s.customers), "v_regional_analysis")


@query
def load_dim_date_new(s: Star) -> DataFrame:
    stored = calendar.calendar_full(calendar.days_spanned(s.raw("orders"), "o_orderdate"))
    return fact_ops.absent_rows(s.dates, stored, "date_key")


@query
def load_dim_product_new(s: Star) -> DataFrame:
    return fact_ops.absent_rows(s.products, s.products.where("is_active"), "product_id")


@query
def load_facts_new(s: Star) -> DataFrame:
    stored = s.facts.where(F.col("date_key") < 20000101)
    fresh = fact_ops.absent_rows(fact_ops.fact_columns(s.facts), stored, "transaction_id")
    return fresh.select("transaction_id", "date_key", "customer_sk", "product_sk", "amount", "channel")


@query
def contract_schema(s: Star) -> DataFrame:
    return contracts.DIM_CUSTOMER.conform(s.customers.select([F.col(c).cast("string") for c in s.customers.columns]))


@query
def contract_violations(s: Star) -> DataFrame:
    facts = fact_ops.lookup_keys(fact_ops.with_date_key(s.raw_transactions), s.customers, s.products)
    tables = {"dim_customer": s.customers, "dim_product": s.products, "dim_branch": s.branches, "dim_date": s.dates,
              "fact_transactions": facts}
    rules = {name: contracts.WAREHOUSE_TABLES[name].rules() for name in tables}
    results = quality.run_table_rules(s.spark, rules, tables)
    return results.select("table_name", "check_type", "columns", "passed", "violations")


@query
def contract_defaults(s: Star) -> DataFrame:
    conformed = contracts.FACT_TRANSACTIONS.conform(s.raw_transactions)
    return conformed.select("transaction_id", "amount", "fee", "is_fraudulent", "balance_after")


# --- dimension builders and keys --------------------------------------------------------------------------

@query
def dim_date_full(s: Star) -> DataFrame:
    return s.dates


@query
def dim_date_basic(s: Star) -> DataFrame:
    return calendar.calendar_basic(calendar.days_spanned(s.raw("lineitem"), "l_shipdate"))


@query
def dim_product_dedup(s: Star) -> DataFrame:
    first = s.products.withColumn("seq", F.lit(1))
    again = s.products.where("NOT is_active").withColumns({"product_name": F.upper("product_name"), "seq": F.lit(2)})
    return dedup.keep_last(first.unionByName(again), "product_id", "seq").select("product_id", "product_name", "product_type")


@query
def surrogate_keys(s: Star) -> DataFrame:
    stored = s.products.select(F.col("product_sk").alias("order_sk"))
    keyed = assign_surrogate_keys(s.raw("orders").select("o_orderkey"), "order_sk", existing=stored)
    return keyed.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("order_sk").alias("n_keys"),
        F.min("order_sk").alias("first_key"), F.max("order_sk").alias("last_key"),
    )


@query
def dim_customer_initial(s: Star) -> DataFrame:
    fresh = scd2.initial_versions(s.customers.select("customer_id", *contracts.CUSTOMER_ATTRIBUTES), AS_OF)
    return fresh.drop("customer_sk")


# --- projections and derived columns ----------------------------------------------------------------------

@query
def customers_current(s: Star) -> DataFrame:
    return fact_ops.current_customers(_applied(s)).select("customer_id", "customer_segment", "city", "version")


@query
def facts_required_not_null(s: Star) -> DataFrame:
    return fact_ops.complete_rows(fact_ops.with_date_key(s.raw_transactions))


@query
def facts_valid_dates(s: Star) -> DataFrame:
    return fact_ops.valid_dates(fact_ops.with_date_key(s.raw_transactions))


@query
def amount_zscore(s: Star) -> DataFrame:
    scored = s.event_facts.join(fraud.amount_stats(s.event_facts), "customer_sk", "left")
    z = C.zscore(F.col("amount").cast("double"), F.col("mean_amount"), F.col("stddev_amount"))
    return scored.select("transaction_sk", "customer_sk", z.alias("amount_zscore"))


@query
def numeric_coerce_zero(s: Star) -> DataFrame:
    return C.with_numbers_or_zero(s.customers.select("customer_id", "zip_code"), ["zip_code"])


@query
def age_group(s: Star) -> DataFrame:
    age = D.completed_years(F.col("date_of_birth"), D.as_of_date(AS_OF))
    return s.customers.select("customer_id", age.alias("age"), C.age_group(age).alias("age_group"))


@query
def risk_category(s: Star) -> DataFrame:
    score = (F.floor(F.col("c_acctbal") / 25) + 400).cast("int")
    return s.raw("customer").select("c_custkey", score.alias("credit_score"), C.risk_category(score).alias("risk_category"))


@query
def txn_description(s: Star) -> DataFrame:
    text = C.describe_transaction(F.col("transaction_type"), F.col("merchant_category"))
    return s.event_facts.select("transaction_sk", text.alias("description"))


@query
def weekend_payday_flags(s: Star) -> DataFrame:
    day = F.to_date("o_orderdate")
    return s.raw("orders").select("o_orderkey", D.is_weekend(day).alias("is_weekend"), D.is_payday(day).alias("is_payday"))


@query
def empty_in_empty_out(s: Star) -> DataFrame:
    return revenue.monthly_revenue(s.facts.where("amount < 0"), s.dates, s.products)


# --- joins ------------------------------------------------------------------------------------------------

@query
def facts_key_lookup_left(s: Star) -> DataFrame:
    return fact_ops.lookup_keys(s.facts.drop("customer_sk", "product_sk"), s.customers, s.products, s.branches).select(
        "transaction_id", "customer_sk", "product_sk", "branch_sk"
    )


@query
def facts_bound_as_of(s: Star) -> DataFrame:
    """Every order of a customer counts as a version of the customer, valid from the order's day."""
    orders = s.raw("orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("effective_date"),
        F.col("o_orderkey").cast("long").alias("customer_sk"))
    versions = ordered.with_position(orders, "customer_id", ["effective_date", "customer_sk"], "version").withColumn("version", F.col("version") + 1)
    raw = fact_ops.with_date_key(s.raw_transactions)
    return fact_ops.lookup_keys(raw, versions, s.products, as_of_date=True).select("transaction_id", "customer_sk", "product_sk")


@query
def facts_key_lookup_strict(s: Star) -> DataFrame:
    return fact_ops.lookup_keys_strict(s.raw_transactions, s.customers, s.products).select(
        "transaction_id", "customer_sk", "product_sk"
    )


@query
def customers_left_facts(s: Star) -> DataFrame:
    held = calendar.with_full_date(s.facts.select("customer_sk", "date_key"), s.dates).groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("n"), F.max("full_date").alias("last_date")
    )
    return s.customers.join(held, "customer_sk", "left").select(
        "customer_id", F.coalesce("n", F.lit(0)).alias("n"), "last_date"
    )


@query
def product_pairs(s: Star) -> DataFrame:
    owned = staged(baskets.ownership(s.facts), "owned")
    counts = baskets.owner_counts(owned)
    return baskets.pair_support(baskets.pair_counts(owned, counts=counts), counts)


@query
def scd2_detect(s: Star) -> DataFrame:
    last = dedup.keep_last(s.customer_batch, "customer_id", "seq")
    return scd2.compare_to_current(last, s.retail).select("customer_id", "old_version", "is_changed")


# --- aggregations -----------------------------------------------------------------------------------------

@query
def agg_basic_by_customer(s: Star) -> DataFrame:
    return s.facts.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"),
        C.mean_of(F.sum("amount"), F.count("amount")).alias("mean"),
        F.min("amount").alias("low"), F.max("amount").alias("high"),
    )


@query
def agg_distinct_products(s: Star) -> DataFrame:
    return dedup.distinct_counts(s.facts, "customer_sk", "product_sk", "product_count")


@query
def agg_channel_counts(s: Star) -> DataFrame:
    return s.facts.groupBy("customer_sk").agg(*customer.channel_counts())


@query
def agg_credit_debit(s: Star) -> DataFrame:
    return s.facts.groupBy("customer_sk").agg(*customer.credit_debit_totals())


@query
def agg_stddev(s: Star) -> DataFrame:
    return fraud.amount_stats(s.facts)


@query
def agg_lookback_counts(s: Star) -> DataFrame:
    return s.facts.groupBy("customer_sk").agg(*churn.lookback_counts(F.col("transaction_date"), AS_OF))


@query
def agg_period_compare(s: Star) -> DataFrame:
    return churn.period_comparison(s.facts.groupBy("customer_sk"), F.col("transaction_date"), AS_OF)


@query
def customer_products(s: Star) -> DataFrame:
    return baskets.ownership(s.facts)


@query
def product_owner_counts(s: Star) -> DataFrame:
    return baskets.owner_counts(baskets.ownership(s.facts))


@query
def product_pair_counts(s: Star) -> DataFrame:
    return baskets.pair_counts(baskets.ownership(s.facts))


@query
def merchant_risk(s: Star) -> DataFrame:
    return fraud.merchant_risk(s.event_facts)


@query
def hourly_velocity(s: Star) -> DataFrame:
    return fraud.hourly_velocity(s.event_facts)


def _sold(s: Star) -> DataFrame:
    return s.facts.join(s.products.select("product_sk", "product_category"), "product_sk")


@query
def pivot_product_counts(s: Star) -> DataFrame:
    return baskets.pivot_counts(_sold(s), "customer_sk", "product_category", PRODUCT_CATEGORIES, "prod_count_", "amount")


@query
def pivot_category_spend(s: Star) -> DataFrame:
    return baskets.pivot_sums(s.facts, "customer_sk", "transaction_category", list(CATEGORIES.values()), "cat_spend_", "amount")


@query
def pivot_channel_spend(s: Star) -> DataFrame:
    return baskets.pivot_sums(s.facts, "customer_sk", "channel", list(CHANNELS.values()), "chan_spend_", "amount")


@query
def ownership_matrix(s: Star) -> DataFrame:
    return baskets.ownership_matrix(s.category_ownership, PRODUCT_CATEGORIES)


@query
def owned_categories(s: Star) -> DataFrame:
    return baskets.owned_sets(s.category_ownership)


@query
def affinity_matrix(s: Star) -> DataFrame:
    return baskets.affinity_matrix(s.category_ownership, PRODUCT_CATEGORIES)


@query
def avg_affinity(s: Star) -> DataFrame:
    return baskets.mean_affinity(s.category_ownership, PRODUCT_CATEGORIES)


# --- windows and deduplication ----------------------------------------------------------------------------

@query
def lag_prev_tx(s: Star) -> DataFrame:
    rows = s.event_facts.select("transaction_sk", "customer_sk", "created_at")
    return ordered.with_previous(rows, "customer_sk", "created_at", "transaction_sk", "prev_tx_time")


@query
def running_balance(s: Star) -> DataFrame:
    rows = s.event_facts.select("transaction_sk", "customer_sk", "created_at", "transaction_type", "amount")
    signed = C.signed_amount(F.col("transaction_type"), F.col("amount"))
    return ordered.with_running_sum(rows, "customer_sk", "created_at", "transaction_sk", signed, "balance").select(
        "transaction_sk", "customer_sk", "balance"
    )


@query
def dedup_keep_last(s: Star) -> DataFrame:
    events = s.raw("events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedup.keep_last(events, "user_id", ["ts", "event_id"])


@query
def dedup_distinct(s: Star) -> DataFrame:
    return dedup.distinct_rows(s.facts, ["customer_id", "channel"])


@query
def customer_latest_version(s: Star) -> DataFrame:
    return dedup.latest_version(_applied(s)).select("customer_id", "customer_segment", "city", "effective_date", "version")


# --- SCD2 -------------------------------------------------------------------------------------------------

def _changes(s: Star, **options) -> DataFrame:
    return scd2.detect_changes(s.customer_batch, s.retail, AS_OF, order="seq", **options)


def _applied(s: Star, **options) -> DataFrame:
    return scd2.apply_changes(s.retail, _changes(s, **options), AS_OF)


@query
def scd2_changes(s: Star) -> DataFrame:
    return _changes(s)


@query
def scd2_tracked_subset(s: Star) -> DataFrame:
    return _changes(s, tracked=["customer_name", "customer_segment"]).select("customer_id", "customer_segment", "city", "version")


@query
def scd2_apply(s: Star) -> DataFrame:
    return _applied(s).drop("customer_sk")


@query
def scd2_apply_next_day(s: Star) -> DataFrame:
    return _applied(s, effective_offset_days=1).drop("customer_sk")


# --- data quality -----------------------------------------------------------------------------------------

def _plain(results: DataFrame) -> DataFrame:
    return results.select("check_type", "columns", "passed", "violations", "message")


@query
def dq_not_null(s: Star) -> DataFrame:
    return _plain(quality.run_checks(s.customers, {"not_null": {"columns": ["customer_id", "phone", "gender", "no_such"]}}))


@query
def dq_unique(s: Star) -> DataFrame:
    return _plain(quality.run_checks(s.customers, {"unique": {"columns": ["customer_id", "phone", "state"]}})).unionByName(
        _plain(quality.run_checks(s.raw("lineitem"), {"unique": {"columns": ["l_orderkey"]}}))
    )


@query
def dq_values_in_set(s: Star) -> DataFrame:
    checks = {"values_in_set": [
        {"column": "o_orderstatus", "valid_values": ["O", "F"]},
        {"column": "o_orderpriority", "valid_values": list(CHANNELS)},
    ]}
    return _plain(quality.run_checks(s.raw("orders"), checks))


@query
def dq_invalid_values(s: Star) -> DataFrame:
    return quality.invalid_values(s.raw("orders"), "o_orderstatus", ["O", "F"])


@query
def dq_range(s: Star) -> DataFrame:
    checks = {"range": [
        {"column": "c_acctbal", "min_val": 0, "max_val": 9000}, {"column": "c_acctbal", "min_val": -1000},
        {"column": "c_acctbal", "max_val": 5000},
    ]}
    return _plain(quality.run_checks(s.raw("customer"), checks))


@query
def dq_regex(s: Star) -> DataFrame:
    return _plain(quality.run_checks(s.customers, {"regex": {"column": "zip_code", "pattern": r"^\d{5}$"}}))


@query
def dq_date_format(s: Star) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("ts").cast("string"))
    events = s.raw("events").select(text.alias("seen_at"))
    return _plain(quality.run_checks(events, {"date_format": {"column": "seen_at", "fmt": "%Y-%m-%d %H:%M:%S.%f"}}))


@query
def dq_referential(s: Star) -> DataFrame:
    checks = {"referential_integrity": {"column": "customer_id", "reference_df": s.customers, "ref_column": "customer_id"}}
    return _plain(quality.run_checks(s.raw_transactions, checks))


@query
def dq_orphans(s: Star) -> DataFrame:
    return quality.orphans(s.raw_transactions, "customer_id", s.customers, "customer_id")


@query
def dq_orphans_top20(s: Star) -> DataFrame:
    return quality.first_orphans(s.raw_transactions, "customer_id", s.customers, "customer_id")


@query
def dq_freshness(s: Star) -> DataFrame:
    late = quality.run_checks(s.raw("orders"), {"freshness": {"date_column": "o_orderdate", "max_age_days": 30}}, AS_OF)
    fresh = quality.run_checks(s.raw("events"), {"freshness": {"date_column": "ts", "max_age_days": 30}}, EVENTS_AS_OF)
    none = quality.run_checks(s.raw("events"), {"freshness": {"date_column": "props", "max_age_days": 30}}, EVENTS_AS_OF)
    return _plain(late.unionByName(fresh).unionByName(none))


@query
def dq_config_run(s: Star) -> DataFrame:
    rules = {**DEFAULT_CONFIG["quality_checks"], "no_such_table": {"not_null": ["x"]}}
    keyed = fact_ops.lookup_keys(fact_ops.with_date_key(s.raw_transactions), s.customers, s.products)
    tables = {"dim_customer": s.customers, "dim_product": s.products, "fact_transactions": keyed}
    results = quality.run_table_rules(s.spark, rules, tables)
    return results.select("table_name", "check_type", "columns", "passed", "violations")


def _mixed_checks(s: Star) -> DataFrame:
    checks = {
        "not_null": {"columns": ["customer_id", "phone"]},
        "unique": {"columns": ["customer_id", "email"]},
        "values_in_set": {"column": "gender", "valid_values": ["Male", "Female"]},
        "regex": {"column": "zip_code", "pattern": r"\d{5}$"},
        "referential_integrity": {"column": "state", "reference_df": s.raw("nation"), "ref_column": "n_name"},
        "freshness": {"date_column": "effective_date", "max_age_days": 30},
        "range": {"column": "customer_name", "min_val": 0},
        "no_such_check": {},
    }
    return quality.run_checks(s.customers, checks, AS_OF)


@query
def dq_summary(s: Star) -> DataFrame:
    return quality.summarize(_mixed_checks(s))


@query
def dq_report(s: Star) -> DataFrame:
    results = _mixed_checks(s)
    detail = F.array_join(F.array_sort(F.transform(F.map_entries("details"), lambda e: F.concat(e.key, F.lit("="), e.value))), ";")
    return results.select("check_type", "columns", "passed", "message", detail.alias("details"))


# --- analytical tables ------------------------------------------------------------------------------------

@query
def v_churn_risk(s: Star) -> DataFrame:
    return churn.churn_risk(s.customers, s.facts, s.dates, AS_OF)


@query
def v_cross_sell_affinity(s: Star) -> DataFrame:
    return cross_sell.cross_sell_affinity(s.facts, s.products, with_lift=True)


@query
def v_monthly_revenue(s: Star) -> DataFrame:
    return revenue.monthly_revenue(s.facts, s.dates, s.products)


@query
def customer_features(s: Star) -> DataFrame:
    return customer.customer_features(s.customers, s.facts, s.dates, AS_OF)


@query
def churn_features(s: Star) -> DataFrame:
    return churn.churn_features(s.customers, s.facts, s.dates, AS_OF)


@query
def cross_sell_features(s: Star) -> DataFrame:
    return cross_sell.cross_sell_features(
        s.customers, s.facts, s.products, AS_OF, PRODUCT_CATEGORIES, list(CATEGORIES.values()), list(CHANNELS.values())
    )


@query
def customer_snapshot(s: Star) -> DataFrame:
    return customer.customer_snapshot(s.customers, s.facts, s.dates, "1999-06-30")


@query
def product_performance(s: Star) -> DataFrame:
    return performance.product_performance(s.products, s.facts, s.dates)


@query
def regional_analysis(s: Star) -> DataFrame:
    return performance.regional_analysis(s.facts, s.customers)


@query
def fraud_features(s: Star) -> DataFrame:
    return fraud.fraud_features(s.event_facts, s.event_dates)


@query
def materialized_row_counts(s: Star) -> DataFrame:
    database, place = scratch_database(s.spark)
    s.spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    star = StarTables(s.customers, s.products, s.event_dates, s.event_facts)
    # of the cross-sell features only rows count whose pivots add up to what the customer's sold facts hold
    held = {"product_category": ("prod_count_", F.count("amount")), "transaction_category": ("cat_spend_", F.sum("amount")), "channel": ("chan_spend_", F.sum("amount"))}
    sold = s.event_facts.join(s.products.select("product_sk", "product_category"), "product_sk")

    def stored(table: str) -> DataFrame:
        rows = s.spark.read.table(table)
        if not table.endswith(".vw_cross_sell_features"):
            return rows
        for column, (prefix, measure) in held.items():
            parts = sold.where(F.col(column).isNotNull()).groupBy("customer_sk", column).agg(measure.alias("part"))
            whole = parts.groupBy("customer_sk").agg(F.sum("part").alias("whole"), F.count_if(F.coalesce(F.col("part"), F.lit(0)) != 0).alias("filled"))
            pivot = [F.col(c) for c in rows.columns if c.startswith(prefix)]
            filled = reduce(lambda a, b: a + b, [F.when(c != 0, 1).otherwise(0) for c in pivot], F.lit(0))
            total = reduce(lambda a, b: a + b, pivot, F.lit(0))
            rows = rows.join(whole, "customer_sk", "left").where(
                (total == F.coalesce("whole", F.lit(0))) & (filled == F.coalesce("filled", F.lit(0)))).drop("whole", "filled")
        return rows

    counts = [
        stored(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t.split(".")[1]).alias("table_name"), "n")
        for t in materialize_all(star, database, EVENTS_AS_OF)
    ]
    return reduce(DataFrame.unionByName, counts)


# --- loads ------------------------------------------------------------------------------------------------

def _warehouse(s: Star, **config) -> Warehouse:
    database, place = scratch_database(s.spark)
    settings = {**DEFAULT_CONFIG, "date_range_start": "1995-01-01", "date_range_end": "2001-12-31", **config}
    return Warehouse(s.spark, database, place, AS_OF, settings).create()


def _bound_facts(w: Warehouse) -> DataFrame:
    """Loaded facts with natural keys in place of the assigned ones."""
    customers = w.table("dim_customer").select("customer_sk", "customer_id", "version")
    products = w.table("dim_product").select("product_sk", "product_id")
    return w.table("fact_transactions").join(customers, "customer_sk").join(products, "product_sk").select(
        "transaction_id", "date_key", "customer_id", "version", "product_id", "amount"
    )


def _source_tables(s: Star) -> dict[str, DataFrame]:
    return {
        "dim_date": s.dates, "dim_branch": s.branches.drop("branch_sk"), "dim_product": s.products.drop("product_sk"),
        "dim_customer": s.customers.select("customer_id", *contracts.CUSTOMER_ATTRIBUTES),
        "transactions": s.facts.drop("customer_sk", "product_sk", "date_key"),
    }


@query
def load_initial_facts(s: Star) -> DataFrame:
    w = _warehouse(s)
    w.initial_load(_source_tables(s))
    branches = w.table("dim_branch").select("branch_sk", "branch_id")
    return _bound_facts(w).join(
        w.table("fact_transactions").join(branches, "branch_sk", "left").select("transaction_id", "branch_id", "fee", "status"),
        "transaction_id",
    )


@query
def facts_transform(s: Star) -> DataFrame:
    return fact_ops.transform_transactions(s.raw_transactions, s.customers, s.products).select(
        "transaction_id", "transaction_date", "date_key", "customer_sk", "product_sk", "amount"
    )


@query
def load_full(s: Star) -> DataFrame:
    w = _warehouse(s)
    w.full_load(
        csv_copy(s.raw_transactions, "transactions"),
        csv_copy(s.customers.select("customer_id", *contracts.CUSTOMER_ATTRIBUTES), "customers"),
        csv_copy(s.products.drop("product_sk"), "products"),
    )
    return _bound_facts(w)


def _first_load(s: Star) -> Warehouse:
    w = _warehouse(s)
    w.full_load(
        csv_copy(s.raw_transactions.where("transaction_date < '1999-01-01'"), "transactions"),
        csv_copy(s.retail.select("customer_id", *contracts.CUSTOMER_ATTRIBUTES), "customers"),
        csv_copy(s.products.drop("product_sk"), "products"),
    )
    return w


@query
def load_incremental(s: Star) -> DataFrame:
    """Early transactions, then all of them together with a customer batch, twice."""
    w = _first_load(s)
    transactions = csv_copy(s.raw_transactions, "transactions")
    batch = csv_copy(dedup.keep_last(s.customer_batch, "customer_id", "seq").drop("seq"), "customers")
    w.incremental_load(transactions, batch)
    w.incremental_load(transactions, batch)
    return _bound_facts(w)


@query
def materialized_incremental(s: Star) -> DataFrame:
    """Customer features kept from monthly aggregates: early transactions, then all of them."""
    w, tables = _warehouse(s), _source_tables(s)
    for batch in (tables["transactions"].where("transaction_date < '1999-01-01'"), tables["transactions"]):
        w.initial_load({**tables, "transactions": batch})
        w.materialize(incremental=True)
    return w.table("vw_customer_features").drop("customer_sk")


@query
def load_stream_facts(s: Star) -> DataFrame:
    """Early transactions from files, then all of them as a stream, started twice."""
    w = _first_load(s)
    declared = s.raw_transactions.select([
        (F.col(c) if c in s.raw_transactions.columns else F.lit(None).cast("string")).alias(c)
        for c in contracts.TRANSACTIONS_FILE.fieldNames()
    ])
    folder = csv_copy(declared, "arrivals")
    checkpoint = scratch_path(s.spark, "stream")
    for _ in range(2):
        load_stream(w, transaction_stream(s.spark, folder), checkpoint).awaitTermination()
    return _bound_facts(w)


@query
def warehouse_end_to_end(s: Star) -> DataFrame:
    checks = {
        "dim_customer": {"where": "is_current", "not_null": ["customer_id", "email"], "unique": ["customer_id"]},
        "fact_transactions": {
            "not_null": ["transaction_id", "customer_sk", "product_sk", "amount", "date_key"],
            "unique": ["transaction_id"], "range": {"amount": [0.01, 1000000]},
        },
        "dim_product": {"not_null": ["product_id", "product_name"], "unique": ["product_id"]},
    }
    w = _warehouse(s, quality_checks=checks)
    batch = dedup.keep_last(s.customer_batch, "customer_id", "seq").drop("seq")
    w.run(_source_tables(s), scratch_path(s.spark, "export"), batch)
    versions = w.table("dim_customer").select("customer_sk", "version", "effective_date")
    return w.table("v_churn_risk").join(versions, "customer_sk").drop("customer_sk")


@query
def load_null_keys_twice(s: Star) -> DataFrame:
    """Products, those of small size without an id, loaded twice."""
    w = _warehouse(s)
    products = s.products.drop("product_sk").join(s.raw("part").select(F.concat(F.lit("P"), "p_partkey").alias("product_id"), "p_size"), "product_id")
    batch = products.withColumn("product_id", F.when(F.col("p_size") > 5, F.col("product_id"))).drop("p_size")
    for _ in range(2):
        w.load_products(batch)
    return w.table("dim_product").select("product_id", "product_name")


@query
def load_rejected_rows(s: Star) -> DataFrame:
    """Facts, those without a fee with an amount that is no number, into a warehouse that takes complete rows only."""
    w = _warehouse(s)
    w.strict = True
    tables = _source_tables(s)
    amount = F.when(F.col("fee") == 0, "n/a").otherwise(F.col("amount").cast("string"))
    w.initial_load({**tables, "transactions": tables["transactions"].withColumn("amount", amount)})
    return w.table("rejected_rows").select("table_name", "columns", F.get_json_object("row", "$.transaction_id").alias("transaction_id"))


@query
def load_customer_snapshot(s: Star) -> DataFrame:
    """The stored snapshot of a day, loaded twice."""
    w = _warehouse(s)
    w.initial_load(_source_tables(s))
    for _ in range(2):
        w.load_snapshot("1999-06-30")
    customers = w.table("dim_customer").select("customer_sk", "customer_id")
    return w.table("fact_customer_snapshot").join(customers, "customer_sk").select(
        "customer_id", "date_key", "total_transactions", F.col("total_amount"), "num_products", "days_since_last_transaction", "is_active"
    )


@query
def stored_views(s: Star) -> DataFrame:
    """The revenue views of two warehouses in one session: one of all facts, one of those before 1996."""
    out = []
    for name, facts in (("all", s.facts), ("early", s.facts.where("transaction_date < '1996-01-01'"))):
        w = _warehouse(s)
        w.initial_load({**_source_tables(s), "transactions": facts.drop("customer_sk", "product_sk", "date_key")})
        w.create_views()
        out.append(w.table("v_monthly_revenue").select(F.lit(name).alias("warehouse"), "*"))
    return reduce(DataFrame.unionByName, out)


@query
def dq_isolated_failures(s: Star) -> DataFrame:
    """A NULL in a set, a set of another type and a pattern that only Python knows, beside a check that answers."""
    checks = {
        "not_null": {"columns": ["p_brand"]}, "regex": {"column": "p_brand", "pattern": r"(?P<y>\d{4})"},
        "values_in_set": [{"column": "p_brand", "valid_values": ["Brand#11", None]}, {"column": "p_name", "valid_values": [1, 2]}],
    }
    return quality.run_checks(s.raw("part"), checks).select("check_type", "columns", "passed", "violations")


@query
def dq_offending_values(s: Star) -> DataFrame:
    checks = {
        "values_in_set": {"column": "p_brand", "valid_values": ["Brand#11", None]},
        "referential_integrity": {"column": "p_size", "reference_df": s.raw("nation"), "ref_column": "n_nationkey"},
    }
    return quality.offending_values(s.raw("part"), checks)
