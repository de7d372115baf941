"""Star schema over the given tables. Every row of every table used takes part.

Customers are the customer rows plus the supplier rows, which have no transactions. Line items are the transactions of
their order's customer; events are the transactions with a time of day.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.contracts import DIM_BRANCH, DIM_CUSTOMER, DIM_PRODUCT
from starmart.functions.dates import date_key
from starmart.operators.calendar import calendar_full, days_spanned

AS_OF = "2001-09-01 12:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
MONEY = "decimal(15,2)"

CHANNELS = {
    "1-URGENT": "Online", "2-HIGH": "Mobile", "3-MEDIUM": "ATM", "4-NOT SPECIFIED": "Branch", "5-LOW": "POS",
}
STATUSES = {"O": "Pending", "F": "Completed", "P": "Failed"}
CATEGORIES = {"A": "Withdrawal", "N": "Purchase", "R": "Deposit"}
PRODUCT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_TYPES = {
    "view": "debit", "click": "credit", "error": "transfer", "purchase": "atm_withdrawal", "signup": "other",
}


def _mapped(column: str, values: dict[str, str]) -> Column:
    chain = F
    for key, value in values.items():
        chain = chain.when(F.col(column) == key, value)
    return chain


class Star:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("city")
        )

    def _people(self, prefix: str, rows: DataFrame, sk: Column) -> DataFrame:
        k = F.col("key")
        balance = F.col("balance")
        people = rows.join(self.places, F.col("nation") == F.col("n_nationkey"), "left")
        return people.select(
            sk.alias("customer_sk"),
            F.concat(F.lit(prefix), k).alias("customer_id"),
            F.col("name").alias("customer_name"),
            F.concat(F.lit("customer"), k, F.lit("@example.com")).alias("email"),
            F.when(balance >= 0, F.concat(F.lit("+1-555-"), k)).alias("phone"),
            F.concat(k, F.lit(" Main St")).alias("address"),
            "city", "state",
            F.when(balance >= 0, F.lpad((k % 100000).cast("string"), 5, "0")).otherwise(F.concat(F.lit("Z"), k)).alias("zip_code"),
            F.lit("US").alias("country"),
            F.date_add(F.lit("1950-01-01").cast("date"), (k % 7000).cast("int") * 3).alias("date_of_birth"),
            F.when(balance < 2500, "Female").when(balance < 5000, "Male").when(balance < 7500, "Non-binary").alias("gender"),
            F.when(balance < 0, "<30k").when(balance < 3000, "30k-60k").when(balance < 6000, "60k-100k")
            .when(balance < 9000, "100k-200k").otherwise(">200k").alias("income_bracket"),
            F.col("segment").alias("customer_segment"),
            F.date_add(F.lit("1985-01-01").cast("date"), (k % 3650).cast("int")).alias("account_open_date"),
            F.lit("2000-01-01").cast("date").alias("effective_date"),
            F.lit(None).cast("date").alias("expiry_date"),
            F.lit(True).alias("is_current"),
            F.lit(1).alias("version"),
        )

    @cached_property
    def retail(self) -> DataFrame:
        rows = self.raw("customer").select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
            F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        )
        return DIM_CUSTOMER.conform(self._people("C", rows, F.col("key") * 2))

    @cached_property
    def business(self) -> DataFrame:
        rows = self.raw("supplier").select(
            F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
            F.col("s_acctbal").alias("balance"), F.lit("BUSINESS").alias("segment"),
        )
        return DIM_CUSTOMER.conform(self._people("S", rows, F.col("key") * 2 + 1))

    @cached_property
    def customers(self) -> DataFrame:
        return self.retail.unionByName(self.business)

    @cached_property
    def products(self) -> DataFrame:
        return DIM_PRODUCT.conform(self.raw("part").select(
            F.col("p_partkey").alias("product_sk"),
            F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("product_type"),
            (F.col("p_size") / 10).alias("interest_rate"),
            F.col("p_retailprice").alias("annual_fee"),
            (F.col("p_size") <= 45).alias("is_active"),
        ))

    @cached_property
    def branches(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return DIM_BRANCH.conform(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("branch_sk"),
            F.concat(F.lit("BR"), F.col("n_nationkey")).alias("branch_id"),
            F.concat(F.lit("Branch "), F.col("n_name")).alias("branch_name"),
            F.col("n_name").alias("city"), F.col("n_name").alias("state"), F.col("r_name").alias("region"),
        ))

    @cached_property
    def dates(self) -> DataFrame:
        return calendar_full(days_spanned(self.raw("lineitem"), "l_shipdate"))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items in the types of the facts, taken before they are dealt to their orders: these are shorter to move."""
        price = F.col("l_extendedprice").cast(MONEY)
        return self.raw("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag",
            F.to_date("l_shipdate").alias("day"),
            F.col("l_quantity").cast("int").alias("units"),
            price.alias("amount"),
            F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias("fee"),
            (F.col("l_quantity") * 100).cast(MONEY).alias("balance_after"),
            (F.col("l_tax") == 0).alias("untaxed"),
            (F.col("l_discount") == 0).alias("undiscounted"),
            (F.col("l_quantity") == 1).alias("single"),
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Line items as facts with surrogate and natural keys. Unused columns are pruned by the optimizer."""
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        day = F.col("day")
        return (
            self.lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws(
                    "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", date_key(day).cast("string"),
                    F.col("units").cast("string"),
                ).alias("transaction_id"),
                day.alias("transaction_date"),
                date_key(day).alias("date_key"),
                (F.col("o_custkey") * 2).alias("customer_sk"),
                F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"),
                F.col("l_partkey").alias("product_sk"),
                F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
                F.concat(F.lit("BR"), F.col("l_suppkey") % 30).alias("branch_id"),
                "amount", "fee", "balance_after",
                F.when(F.col("l_linestatus") == "O", "Credit").otherwise("Debit").alias("transaction_type"),
                _mapped("l_returnflag", CATEGORIES).alias("transaction_category"),
                _mapped("o_orderpriority", CHANNELS).alias("channel"),
                _mapped("o_orderstatus", STATUSES).alias("status"),
            )
        )

    @cached_property
    def category_ownership(self) -> DataFrame:
        from starmart.operators.baskets import ownership

        sold = self.facts.select("customer_sk", "product_sk").join(
            self.products.select("product_sk", "product_category"), "product_sk"
        )
        return ownership(sold, item="product_category")

    @cached_property
    def raw_transactions(self) -> DataFrame:
        """Transactions as a source system would send them, with faults taken from the data.

        Zero-tax lines have no product, zero-discount lines a customer nobody knows, and lines of quantity 1 a date
        long before the calendar. Nothing else is changed.
        """
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        day = F.col("day")
        return self.lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", date_key(day).cast("string"),
                F.col("units").cast("string"),
            ).alias("transaction_id"),
            F.when(F.col("undiscounted"), F.concat(F.lit("X"), F.col("o_custkey"))).otherwise(F.concat(F.lit("C"), F.col("o_custkey"))).alias("customer_id"),
            F.when(~F.col("untaxed"), F.concat(F.lit("P"), F.col("l_partkey"))).alias("product_id"),
            F.when(F.col("single"), F.lit("1850-01-01").cast("date")).otherwise(day).alias("transaction_date"),
            "amount",
        )

    @cached_property
    def event_facts(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("event_id").alias("transaction_sk"),
            (F.col("user_id") * 2).alias("customer_sk"),
            k.cast("long").alias("product_sk"),
            (F.col("value").cast(MONEY) * 10).cast(MONEY).alias("balance_after"),
            date_key(F.to_date("ts")).alias("date_key"),
            F.col("ts").alias("created_at"),
            F.col("value").cast(MONEY).alias("amount"),
            F.col("event_type").alias("merchant_category"),
            _mapped("event_type", EVENT_TYPES).alias("transaction_type"),
            F.when(k < 25, "Online").when(k < 50, "Mobile").when(k < 75, "ATM").otherwise("Branch").alias("channel"),
            F.when(F.col("value") < 100, "Purchase").otherwise("Deposit").alias("transaction_category"),
            (k < 5).alias("is_fraudulent"),
        )

    @cached_property
    def event_dates(self) -> DataFrame:
        return calendar_full(days_spanned(self.raw("events"), "ts"))

    @cached_property
    def customer_batch(self) -> DataFrame:
        """An update of the retail customers: negative balances get a new segment, high ones are sent twice with a new
        city the second time, and all businesses are new."""
        attributes = [c for c in self.retail.columns if c not in ("customer_sk", "effective_date", "expiry_date", "is_current", "version")]
        changed = F.when(F.col("income_bracket") == "<30k", F.concat("customer_segment", F.lit(" [upd]"))).otherwise(F.col("customer_segment"))
        first = self.retail.select(*attributes).withColumn("customer_segment", changed).withColumn("seq", F.lit(1))
        again = (
            self.retail.where("income_bracket = '>200k'").select(*attributes)
            .withColumn("city", F.concat("city", F.lit(" (moved)"))).withColumn("seq", F.lit(2))
        )
        new = self.business.select(*attributes).withColumn("seq", F.lit(1))
        return first.unionByName(again).unionByName(new)
