"""Declarative data-quality checks that run as Spark aggregations.

All checks of a table that need no grouping (NULLs, ranges, patterns, formats, freshness) share one scan and one
aggregate. Uniqueness is the rows of that aggregate less the distinct values, so whatever only adds rows or other columns,
such as a lookup, is not worked out for the values again. Value sets and references each group by value first, so a value with a
third of all rows is combined on the map side. Results are DataFrames of one row per check; lists of offending values are DataFrames of
their own (:func:`invalid_values`, :func:`orphans`) and are never gathered into one row.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starmart.functions.dates import as_of_timestamp, spark_datetime_pattern
from starmart.sources.readers import is_missing_source

log = logging.getLogger(__name__)

# --- fixed values: result messages ------------------------------------------------------------------------
MESSAGES = {
    "not_null": "Column '%s': %d null(s) found.",
    "unique": "Column '%s': %d duplicate(s) found.",
    "values_in_set": "Column '%s': %d invalid value(s).",
    "regex": "Column '%s': %d value(s) did not match pattern '{}'.",
    "date_format": "Column '%s': %d value(s) failed to parse with format '{}'.",
    "referential_integrity": "Column '%s': %d orphaned value(s).",
    "missing": "Column '{}' does not exist.",
    "exception": "Check raised an exception.",
    "range": "Column '{}': ",
    "range_below": "%d value(s) below %s",
    "range_above": "%d value(s) above %s",
    "range_passed": "all values in range.",
    "freshness": "Column '{}': most recent date is %d day(s) old (max allowed: {}).",
    "freshness_undated": "Column '{}' has no parseable dates.",
}
# ----------------------------------------------------------------------------------------------------------

RESULT_SCHEMA = T.StructType([
    T.StructField("check_type", T.StringType()),
    T.StructField("columns", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("violations", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
])
_COLUMNS = RESULT_SCHEMA.fieldNames()


class QualityGateError(RuntimeError):
    """Raised when a gated run has failed checks."""


@dataclass
class _Scalar:
    """A check answered by one or more aggregates over the table."""

    check_type: str
    column: str
    aggregates: dict[str, Column]
    #: Builders of the result fields; each gets the number under which the aggregates are named.
    result: dict[str, Callable[[int], Column]]
    #: One row of one number that is taken off the aggregate ``n``.
    less: DataFrame | None = None


# --- single checks: column expressions --------------------------------------------------------------------

def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def out_of_range_counts(column: str, min_val=None, max_val=None) -> tuple[Column, Column]:
    """Values below and above the inclusive bounds; NULLs pass and an absent bound is never broken."""
    value = F.col(column)
    below = F.count_if(value < F.lit(min_val)) if min_val is not None else F.lit(0).cast("long")
    above = F.count_if(value > F.lit(max_val)) if max_val is not None else F.lit(0).cast("long")
    return below, above


def pattern_mismatch_count(column: str, pattern: str) -> Column:
    """Non-NULL values that do not match from their first character on."""
    return F.count_if(~F.col(column).cast("string").rlike(f"^(?:{pattern})"))


def unparseable_count(column: str, strptime_format: str) -> Column:
    text = F.col(column).cast("string")
    parsed = F.try_to_timestamp(text, F.lit(spark_datetime_pattern(strptime_format)))
    return F.count_if(text.isNotNull() & parsed.isNull())


# --- single checks: grouped -------------------------------------------------------------------------------

def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct values, NULL being one value. Always exact; Spark leaves out left joins that only add other columns."""
    return df.groupBy(column).count().agg(F.count(F.lit(1)).alias("n"))


def invalid_values(df: DataFrame, column: str, valid_values: Sequence) -> DataFrame:
    """Distinct non-NULL values outside the set, one per row."""
    value = F.col(column)
    return df.where(value.isNotNull() & ~_in_set(df, column, valid_values)).select(value.alias("value")).distinct()


def _in_set(df: DataFrame, column: str, valid_values: Sequence) -> Column:
    """Whether a value is in the set, compared as the column's type. A NULL in the set stands for nothing.

    The set is a list of literals, which Spark looks up by hash when it is long.
    """
    kind = df.schema[column].dataType
    wanted = [F.lit(v).cast("string").try_cast(kind) for v in valid_values if v is not None]
    return F.coalesce(F.col(column).isin(*wanted), F.lit(False)) if wanted else F.lit(False)


def orphans(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """Distinct non-NULL child values without a parent row, one per row."""
    child = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return child.join(reference.select(F.col(ref_column).alias("value")), "value", "left_anti")


def first_orphans(df: DataFrame, column: str, reference: DataFrame, ref_column: str, n: int = 20) -> DataFrame:
    """The first ``n`` orphaned values in order, a top-n report."""
    return orphans(df, column, reference, ref_column).orderBy("value").limit(n)


def newest_date(column: str) -> Column:
    """Latest parseable date; text that is no date is ignored."""
    return F.max(F.try_to_timestamp(F.col(column).cast("string")).cast("timestamp_ntz"))


# --- batch runner -----------------------------------------------------------------------------------------

def run_checks(df: DataFrame, checks: Mapping[str, Mapping], as_of=None) -> DataFrame:
    """Run checks given as ``{check type: arguments}`` and return one result row per check and column.

    ``not_null`` and ``unique`` take ``columns``; ``values_in_set`` ``column, valid_values``; ``range`` ``column,
    min_val, max_val``; ``regex`` ``column, pattern``; ``date_format`` ``column, fmt``; ``referential_integrity``
    ``column, reference_df, ref_column``; ``freshness`` ``date_column, max_age_days``. The arguments may also be a
    list of such mappings. A missing column fails its check, an unknown check type is skipped, and a check with
    unusable arguments fails without stopping the others.
    """
    spark = df.sparkSession
    scalars: list[_Scalar] = []
    grouped: list[DataFrame] = []
    fixed: list[tuple] = []

    for check_type, spec in checks.items():
        if check_type not in _BUILDERS:
            log.warning("unknown check type %r skipped", check_type)
            continue
        for arguments in spec if isinstance(spec, (list, tuple)) else [spec]:
            try:
                for built in _BUILDERS[check_type](df, as_of=as_of, **arguments):
                    if isinstance(built, _Scalar):
                        scalars.append(built)
                    elif isinstance(built, DataFrame):
                        grouped.append(built)
                    else:
                        fixed.append(built)
            except (TypeError, ValueError, re.error, AnalysisException) as error:
                log.warning("check %s failed to run: %s", check_type, error)
                fixed.append((check_type, "", False, None, MESSAGES["exception"], {}))

    parts = list(grouped)
    if scalars:
        parts.append(_scalar_results(df, scalars))
    if fixed or not parts:
        parts.append(spark.createDataFrame(fixed, RESULT_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def _scalar_results(df: DataFrame, scalars: list[_Scalar]) -> DataFrame:
    """All scalar checks from one aggregate, unpivoted to a row each."""
    named = [a.alias(f"{i}_{k}") for i, s in enumerate(scalars) for k, a in s.aggregates.items()]
    rows = [
        F.struct(
            F.lit(s.check_type).alias("check_type"),
            F.lit(s.column).alias("columns"),
            *[s.result[c](i).alias(c) for c in ("passed", "violations", "message", "details")],
        )
        for i, s in enumerate(scalars)
    ]
    counted = df.agg(*named)
    for i, s in enumerate(scalars):
        if s.less is not None:
            counted = counted.withColumn(f"{i}_n", F.col(f"{i}_n") - s.less.scalar())
    return counted.select(F.inline(F.array(*rows))).toDF(*_COLUMNS)


def _missing(check_type: str, column: str) -> list[tuple]:
    return [(check_type, column, False, None, MESSAGES["missing"].format(column), {})]


def _details(**values: Column) -> Column:
    pairs = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs)


def _counting(
    check_type: str, column: str, count: Column, detail: str, argument: str = "", less: DataFrame | None = None, **extra: str
) -> _Scalar:
    message = MESSAGES[check_type].format(argument)

    def violations(i):
        return F.col(f"{i}_n")

    return _Scalar(
        check_type, column, {"n": count},
        {
            "passed": lambda i: (violations(i) == 0),
            "violations": lambda i: violations(i),
            "message": lambda i: F.format_string(_escape(message), F.lit(column), violations(i)),
            "details": lambda i: _details(
                **{detail: violations(i)}, **{k: F.lit(v) for k, v in extra.items()}
            ),
        },
        less,
    )


def _escape(message: str) -> str:
    """Keep the two placeholders and protect any further percent sign (a strptime format has some)."""
    head, _, tail = message.partition("%d")
    return head + "%d" + tail.replace("%", "%%")


def _counted_row(check_type: str, column: str, counted: DataFrame, detail: str) -> DataFrame:
    n = F.col("violations").cast("long")
    return counted.select(
        F.lit(check_type).alias("check_type"),
        F.lit(column).alias("columns"),
        (n == 0).alias("passed"),
        n.alias("violations"),
        F.format_string(MESSAGES[check_type], F.lit(column), n).alias("message"),
        _details(**{detail: n}).alias("details"),
    )


def _each_column(check_type: str, build):
    def builder(df, columns, as_of=None):
        out = []
        for column in columns:
            out += [build(df, column)] if column in df.columns else _missing(check_type, column)
        return out

    return builder


def _not_null(df, column):
    return _counting("not_null", column, null_count(column), "null_count")


def _unique(df, column):
    return _counting("unique", column, F.count(F.lit(1)), "duplicate_count", less=distinct_count(df, column))


def _values_in_set(df, column, valid_values, as_of=None):
    if column not in df.columns:
        return _missing("values_in_set", column)
    counted = invalid_values(df, column, valid_values).agg(F.count(F.lit(1)).alias("violations"))
    return [_counted_row("values_in_set", column, counted, "invalid_value_count")]


def _range(df, column, min_val=None, max_val=None, as_of=None):
    if column not in df.columns:
        return _missing("range", column)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        raise TypeError(f"range check on non-numeric column {column}")
    below, above = out_of_range_counts(column, min_val, max_val)

    def parts(i):
        return F.col(f"{i}_below"), F.col(f"{i}_above")

    def text(i):
        low, high = parts(i)
        found = F.concat_ws(
            "; ",
            F.when(low > 0, F.format_string(MESSAGES["range_below"], low, F.lit(str(min_val)))),
            F.when(high > 0, F.format_string(MESSAGES["range_above"], high, F.lit(str(max_val)))),
        )
        summary = F.when(low + high > 0, found).otherwise(MESSAGES["range_passed"])
        return F.concat(F.lit(MESSAGES["range"].format(column)), summary)

    return [_Scalar(
        "range", column, {"below": below, "above": above},
        {
            "passed": lambda i: (parts(i)[0] + parts(i)[1] == 0),
            "violations": lambda i: (parts(i)[0] + parts(i)[1]),
            "message": lambda i: text(i),
            "details": lambda i: _details(
                min=F.lit(min_val), max=F.lit(max_val), below=parts(i)[0], above=parts(i)[1]
            ),
        },
    )]


def _regex(df, column, pattern, as_of=None):
    if column not in df.columns:
        return _missing("regex", column)
    re.compile(pattern)
    _java_accepts(df.sparkSession, pattern)
    return [_counting("regex", column, pattern_mismatch_count(column, pattern), "mismatch_count", pattern, pattern=pattern)]


def _java_accepts(spark: SparkSession, pattern: str) -> None:
    """Evaluate the pattern on one literal, so that one which only Python knows fails its own check and no other."""
    try:
        spark.range(1).select(F.lit("").rlike(f"^(?:{pattern})")).collect()
    except Exception as error:
        raise ValueError(f"the pattern {pattern!r} is not usable: {error}") from error


def _date_format(df, column, fmt="%Y-%m-%d", as_of=None):
    if column not in df.columns:
        return _missing("date_format", column)
    return [_counting("date_format", column, unparseable_count(column, fmt), "parse_errors", fmt, format=fmt)]


def _referential(df, column, reference_df, ref_column, as_of=None):
    for name, table in ((column, df), (ref_column, reference_df)):
        if name not in table.columns:
            return _missing("referential_integrity", name)
    counted = orphans(df, column, reference_df, ref_column).agg(F.count(F.lit(1)).alias("violations"))
    return [_counted_row("referential_integrity", column, counted, "orphan_count")]


def _freshness(df, date_column, max_age_days, as_of=None):
    if date_column not in df.columns:
        return _missing("freshness", date_column)
    now = as_of_timestamp(as_of)

    def newest(i):
        return F.col(f"{i}_newest")

    def fresh(i):
        return F.coalesce(newest(i) >= now - F.make_dt_interval(F.lit(max_age_days)), F.lit(False))

    def age(i):
        return F.floor(F.timestamp_diff("MICROSECOND", newest(i), now) / F.lit(86_400_000_000.0)).cast("long")

    def text(i):
        dated = F.format_string(MESSAGES["freshness"].format(date_column, max_age_days), age(i))
        return F.when(newest(i).isNull(), MESSAGES["freshness_undated"].format(date_column)).otherwise(dated)

    return [_Scalar(
        "freshness", date_column, {"newest": newest_date(date_column)},
        {
            "passed": lambda i: fresh(i),
            "violations": lambda i: F.when(fresh(i), 0).otherwise(1).cast("long"),
            "message": lambda i: text(i),
            "details": lambda i: _details(
                most_recent=newest(i), age_days=age(i), max_age_days=F.lit(max_age_days)
            ),
        },
    )]


_BUILDERS = {
    "not_null": _each_column("not_null", _not_null),
    "unique": _each_column("unique", _unique),
    "values_in_set": _values_in_set,
    "range": _range,
    "regex": _regex,
    "date_format": _date_format,
    "referential_integrity": _referential,
    "freshness": _freshness,
}


def summarize(results: DataFrame) -> DataFrame:
    """One row: total, passed and failed checks."""
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )


# --- rules per table --------------------------------------------------------------------------------------

def run_table_rules(
    spark: SparkSession, rules: Mapping[str, Mapping], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Run rules given as ``{table: {not_null, unique, values_in_set, range, references, where}}``.

    Tables come from ``tables`` or else from the catalog. A table that cannot be read is a failed row of type
    ``readable``; a rule on a column the table lacks is skipped. ``where`` restricts the rows that are checked, such
    as ``is_current`` for a key that is unique among current versions only. ``references`` maps a column to
    ``[parent table, parent column]``.
    """
    tables = tables or {}
    parts: list[DataFrame] = []

    def load(name: str) -> DataFrame:
        return tables[name] if name in tables else spark.read.table(name)

    for name, table_rules in rules.items():
        try:
            df = load(name)
        except AnalysisException as error:
            if not is_missing_source(error):
                raise
            unreadable = [("readable", "", False, None, f"Cannot read table {name}.", {})]
            parts.append(_for_table(spark.createDataFrame(unreadable, RESULT_SCHEMA), name))
            continue
        if table_rules.get("where"):
            df = df.where(table_rules["where"])
        parts.append(_for_table(run_checks(df, _as_checks(df, table_rules, load)), name))
    if not parts:
        return _for_table(spark.createDataFrame([], RESULT_SCHEMA), "")
    return reduce(DataFrame.unionByName, parts)


def _as_checks(df: DataFrame, rules: Mapping, load) -> dict:
    def present(columns):
        return [c for c in columns if c in df.columns]

    sets, ranges = rules.get("values_in_set", {}), rules.get("range", {})
    references = rules.get("references", {})
    return {
        "not_null": {"columns": present(rules.get("not_null", []))},
        "unique": {"columns": present(rules.get("unique", []))},
        "values_in_set": [{"column": c, "valid_values": sets[c]} for c in present(sets)],
        "range": [{"column": c, "min_val": ranges[c][0], "max_val": ranges[c][1]} for c in present(ranges)],
        "referential_integrity": [
            {"column": c, "reference_df": load(references[c][0]), "ref_column": references[c][1]}
            for c in present(references)
        ],
    }


def _for_table(results: DataFrame, name: str) -> DataFrame:
    return results.select(F.lit(name).alias("table_name"), *_COLUMNS)


def offending_values(df: DataFrame, checks: Mapping[str, Mapping]) -> DataFrame:
    """(check_type, columns, value) for every value that a value set or a reference rejects, one per row and whole.

    Takes the same checks as :func:`run_checks`; kinds of checks without a list of values are passed over.
    """
    parts = [df.sparkSession.createDataFrame([], "check_type string, columns string, value string")]
    for check_type in ("values_in_set", "referential_integrity"):
        spec = checks.get(check_type, [])
        for a in spec if isinstance(spec, (list, tuple)) else [spec]:
            if a["column"] not in df.columns:
                continue
            found = (
                invalid_values(df, a["column"], a["valid_values"]) if check_type == "values_in_set"
                else orphans(df, a["column"], a["reference_df"], a["ref_column"])
            )
            parts.append(found.select(
                F.lit(check_type).alias("check_type"), F.lit(a["column"]).alias("columns"), F.col("value").cast("string").alias("value")
            ))
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> None:
    """Raise :class:`QualityGateError` with every failed check. Pass results that are already written.

    There is one row for each rule, so the message is bounded by the rules.
    """
    lines = [row.message for row in results.where(~F.col("passed")).select("message").collect()]
    if lines:
        raise QualityGateError(f"{len(lines)} data quality check(s) failed: " + " | ".join(lines))
