"""Declared tables: types, keys, defaults, and the quality rules that follow from them.

Parquet tables do not enforce NOT NULL, UNIQUE or foreign keys, so every constraint here is turned into a
check (:meth:`TableContract.rules`) that :mod:`starmart.operators.quality` can run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_B, _TS, _MONEY = T.BooleanType(), T.TimestampType(), T.DecimalType(15, 2)


@dataclass(frozen=True)
class TableContract:
    """One declared table. ``columns`` keeps the declared order."""

    name: str
    columns: dict[str, T.DataType]
    surrogate_key: str | None = None
    natural_key: str | None = None
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns.items()])

    def conform(self, df: DataFrame) -> DataFrame:
        """Cast to the declared types, fill defaults, add absent columns as NULL, drop undeclared ones.

        A value that cannot be cast becomes NULL, and the NOT NULL rules then report it.
        """
        present = set(df.columns)

        def build(name: str, dtype: T.DataType):
            value = F.col(name).try_cast(dtype) if name in present else F.lit(None).cast(dtype)
            if name in self.defaults:
                value = F.coalesce(value, F.lit(self.defaults[name]).cast(dtype))
            return value.alias(name)

        return df.select(*[build(c, t) for c, t in self.columns.items()])

    def rules(self) -> dict[str, object]:
        """The declared constraints as quality rules."""
        return {
            "not_null": list(self.required),
            "unique": list(self.unique),
            "references": {c: list(target) for c, target in self.foreign_keys.items()},
        }

    def create(self, spark: SparkSession, database: str | None = None) -> str:
        """Create the empty table if it does not exist and return its qualified name."""
        table = f"{database}.{self.name}" if database else self.name
        ddl = ", ".join(f"`{c}` {t.simpleString()}" for c, t in self.columns.items())
        layout = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{layout}")
        return table


DIM_DATE = TableContract(
    name="dim_date",
    columns={
        "date_key": _I, "full_date": _D, "day_of_week": _S, "day_of_month": _I, "month": _I, "month_name": _S,
        "quarter": _I, "year": _I, "is_weekend": _B, "is_holiday": _B, "fiscal_year": _I, "fiscal_quarter": _I,
        "week_of_year": _I,
    },
    natural_key="date_key",
    required=("date_key", "full_date"),
    unique=("date_key", "full_date"),
)

#: Descriptive customer columns; a change in any of them opens a new version.
CUSTOMER_ATTRIBUTES: dict[str, T.DataType] = {
    "customer_name": _S, "email": _S, "phone": _S, "address": _S, "city": _S, "state": _S, "zip_code": _S,
    "country": _S, "date_of_birth": _D, "gender": _S, "income_bracket": _S, "customer_segment": _S,
    "account_open_date": _D,
}

DIM_CUSTOMER = TableContract(
    name="dim_customer",
    columns={
        "customer_sk": _L, "customer_id": _S, **CUSTOMER_ATTRIBUTES,
        "effective_date": _D, "expiry_date": _D, "is_current": _B, "version": _I,
    },
    surrogate_key="customer_sk",
    natural_key="customer_id",
    required=("customer_sk", "customer_id", "effective_date", "is_current"),
    unique=("customer_sk",),
    defaults={"is_current": True, "version": 1},
)

DIM_PRODUCT = TableContract(
    name="dim_product",
    columns={
        "product_sk": _L, "product_id": _S, "product_name": _S, "product_category": _S, "product_type": _S,
        "interest_rate": T.DecimalType(5, 2), "annual_fee": T.DecimalType(10, 2), "is_active": _B,
    },
    surrogate_key="product_sk",
    natural_key="product_id",
    required=("product_sk", "product_id"),
    unique=("product_sk", "product_id"),
    defaults={"is_active": True},
)

DIM_BRANCH = TableContract(
    name="dim_branch",
    columns={"branch_sk": _L, "branch_id": _S, "branch_name": _S, "city": _S, "state": _S, "region": _S},
    surrogate_key="branch_sk",
    natural_key="branch_id",
    required=("branch_sk", "branch_id"),
    unique=("branch_sk", "branch_id"),
)

FACT_TRANSACTIONS = TableContract(
    name="fact_transactions",
    columns={
        "transaction_sk": _L, "transaction_id": _S, "date_key": _I, "customer_sk": _L, "product_sk": _L,
        "branch_sk": _L, "amount": _MONEY, "fee": _MONEY, "balance_after": _MONEY, "transaction_type": _S,
        "transaction_category": _S, "channel": _S, "status": _S, "merchant": _S, "merchant_category": _S,
        "created_at": _TS, "is_fraudulent": _B, "date_month": _I,
    },
    surrogate_key="transaction_sk",
    natural_key="transaction_id",
    required=("transaction_sk", "transaction_id", "date_key", "customer_sk", "product_sk", "amount"),
    unique=("transaction_sk",),
    foreign_keys={
        "date_key": ("dim_date", "date_key"),
        "customer_sk": ("dim_customer", "customer_sk"),
        "product_sk": ("dim_product", "product_sk"),
        "branch_sk": ("dim_branch", "branch_sk"),
    },
    defaults={"fee": 0, "is_fraudulent": False},
    partition_by=("date_month",),
)

FACT_CUSTOMER_SNAPSHOT = TableContract(
    name="fact_customer_snapshot",
    columns={
        "snapshot_sk": _L, "date_key": _I, "customer_sk": _L, "total_transactions": _I, "total_amount": _MONEY,
        "avg_transaction_amount": _MONEY, "account_balance": _MONEY, "num_products": _I,
        "days_since_last_transaction": _I, "is_active": _B,
    },
    surrogate_key="snapshot_sk",
    required=("snapshot_sk", "date_key", "customer_sk"),
    unique=("snapshot_sk",),
    foreign_keys={"date_key": ("dim_date", "date_key"), "customer_sk": ("dim_customer", "customer_sk")},
)

#: What a batch of customers must have; versions and keys are assigned later.
DIM_CUSTOMER_BATCH = TableContract(
    name="dim_customer",
    columns={"customer_id": _S},
    natural_key="customer_id",
    required=("customer_id",),
)

#: Rows that a load has turned away: the table they were for, the columns that broke its rules, and the row as JSON.
REJECTED_ROWS = TableContract(
    name="rejected_rows",
    columns={"table_name": _S, "columns": _S, "row": _S},
    required=("table_name", "columns", "row"),
)

WAREHOUSE_TABLES = {
    c.name: c
    for c in (DIM_DATE, DIM_CUSTOMER, DIM_PRODUCT, DIM_BRANCH, FACT_TRANSACTIONS, FACT_CUSTOMER_SNAPSHOT)
}

# Input files. Dates and timestamps arrive as text and are parsed leniently by the readers.
CUSTOMERS_FILE = T.StructType(
    [T.StructField("customer_id", _S)] + [T.StructField(c, t) for c, t in CUSTOMER_ATTRIBUTES.items()]
)
PRODUCTS_FILE = T.StructType([T.StructField(c, t) for c, t in DIM_PRODUCT.columns.items() if c != "product_sk"])
TRANSACTIONS_FILE = T.StructType([
    T.StructField("transaction_id", _S), T.StructField("customer_id", _S), T.StructField("product_id", _S),
    T.StructField("branch_id", _S), T.StructField("transaction_date", _TS), T.StructField("amount", _MONEY),
    T.StructField("fee", _MONEY), T.StructField("balance_after", _MONEY), T.StructField("transaction_type", _S),
    T.StructField("transaction_category", _S), T.StructField("channel", _S), T.StructField("status", _S),
    T.StructField("merchant", _S), T.StructField("merchant_category", _S), T.StructField("created_at", _TS),
    T.StructField("is_fraudulent", _B),
])
BRANCHES_FILE = T.StructType([T.StructField(c, t) for c, t in DIM_BRANCH.columns.items() if c != "branch_sk"])
