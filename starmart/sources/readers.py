"""Sources: typed CSV scans, whole-table scans and parameterised SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starmart import contracts

#: Row position in the input, comparable across files and splits. Used wherever "last row wins".
LOAD_ORDER = "_load_order"

_MISSING_SOURCE = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def _parse(name: str, dtype: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(dtype, T.DateType):
        # A timestamp written where a date is expected still gives its date.
        return F.coalesce(F.try_to_date(text, "y-M-d"), F.to_date(F.try_to_timestamp(text)))
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(text)
    if isinstance(dtype, T.StringType):
        return text
    return F.trim(text).try_cast(dtype)


#: How CSV is written and read: a quote inside quotes is doubled and blanks belong to the text.
CSV_DIALECT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, load_order: bool = False, multi_line: bool = False
) -> DataFrame:
    """Scan CSV files with a header into ``schema``; unparseable fields become NULL.

    Columns are matched by header name, file by file, and may be absent. A missing path gives an empty table. A field
    may hold quotes, written twice; an empty one is NULL, quoted or not; with ``multi_line`` it may hold line ends too, and a file is then read as a whole.
    With ``load_order`` the row position is kept in :data:`LOAD_ORDER`.
    """
    options = {**CSV_DIALECT, "multiLine": multi_line}
    try:
        first = spark.read.options(**options).csv(path)
    except AnalysisException as error:
        if not is_missing_source(error):
            raise
        return _empty(spark, schema, load_order)
    if not first.columns:
        return _empty(spark, schema, load_order)
    scans = [spark.read.options(**options).csv(files) for files in _files_by_header(spark, path)] or [first]
    return reduce(DataFrame.unionByName, [_typed(scan, schema, load_order) for scan in scans])


def _files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files of a path, those with equal first lines together; [] if all are equal.

    The first lines come from one scan of the text. What reaches the driver is a name for each file, as in any scan.
    """
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"), "value"
    )
    headers = lines.groupBy("file").agg(F.min_by("value", "row").alias("header"))
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [g.files for g in groups] if len(groups) > 1 else []


def _typed(scan: DataFrame, schema: T.StructType, load_order: bool) -> DataFrame:
    present = set(scan.columns)
    out = [
        (_parse(f.name, f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    if load_order:
        out.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(LOAD_ORDER)
        )
    return scan.select(*out)


def is_missing_source(error: AnalysisException) -> bool:
    return (error.getCondition() or "").split(".")[0] in _MISSING_SOURCE


def _empty(spark: SparkSession, schema: T.StructType, load_order: bool) -> DataFrame:
    if load_order:
        order = T.StructType([
            T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
            T.StructField("row", T.LongType()),
        ])
        schema = T.StructType(schema.fields + [T.StructField(LOAD_ORDER, order)])
    return spark.createDataFrame([], schema)


def read_transactions(spark: SparkSession, path: str | list[str], load_order: bool = False) -> DataFrame:
    return read_csv(spark, path, contracts.TRANSACTIONS_FILE, load_order)


def read_customers(spark: SparkSession, path: str | list[str], load_order: bool = False) -> DataFrame:
    return read_csv(spark, path, contracts.CUSTOMERS_FILE, load_order)


def read_products(spark: SparkSession, path: str, load_order: bool = False) -> DataFrame:
    return read_csv(spark, path, contracts.PRODUCTS_FILE, load_order)


def read_branches(spark: SparkSession, path: str, load_order: bool = False) -> DataFrame:
    return read_csv(spark, path, contracts.BRANCHES_FILE, load_order)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole-table scan by catalog name."""
    return spark.read.table(name)


def read_query(spark: SparkSession, sql: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with named parameters; DataFrames passed by keyword are usable as ``{name}``."""
    return spark.sql(sql, args=params or {}, **tables)
