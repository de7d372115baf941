"""Derived-column expressions shared by the operators and feature tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# --- fixed values -----------------------------------------------------------------------------------------
#: Left-closed age bands: (lower edge, upper edge, label).
AGE_BANDS = (
    (0, 25, "18-25"),
    (25, 35, "26-35"),
    (35, 45, "36-45"),
    (45, 55, "46-55"),
    (55, 65, "56-65"),
    (65, 100, "65+"),
)
#: Lowest credit score of each risk band; anything lower is ``very_high``.
RISK_BANDS = ((750, "low"), (650, "medium"), (550, "high"))
LOWEST_RISK_LABEL = "very_high"
#: Transaction types that add to a balance; all others reduce it.
INFLOW_TYPES = ("credit", "direct_deposit", "transfer")
#: Leading words of a transaction description.
DESCRIPTION_WORDS = {
    "debit": "Purchase at",
    "credit": "Refund from",
    "transfer": "Transfer to/from",
    "atm_withdrawal": "ATM withdrawal at",
    "direct_deposit": "Direct deposit from",
}
# ----------------------------------------------------------------------------------------------------------


def number_or_zero(value: Column) -> Column:
    """Value as a double; NULL, NaN and unparseable text become 0."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def with_numbers_or_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL becomes 0 in the listed columns; text columns are parsed, numeric ones keep their type."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def coerce(name: str) -> Column:
        if isinstance(kinds[name], (T.IntegralType, T.DecimalType)):
            return F.coalesce(F.col(name), F.lit(0).cast(kinds[name]))
        return number_or_zero(F.col(name))

    return df.withColumns({c: coerce(c) for c in columns})


def relative_change(now: Column, before: Column) -> Column:
    """``(now - before) / before``; 0 unless ``before`` is positive."""
    return F.when(before > 0, (now - before) / before).otherwise(F.lit(0.0))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Standard score; 0 where the spread is missing or not positive."""
    return F.when(stddev > 0, (value - mean) / stddev).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Double division that gives NULL on a zero denominator."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def mean_of(total: Column, count: Column) -> Column:
    """Mean from an exact decimal total and a count; NULL on an empty group."""
    return ratio(total, count)


def age_group(age: Column) -> Column:
    """Band label; an unknown age counts as 0, ages below 0 or from 100 up have no band."""
    known = F.coalesce(age, F.lit(0))
    chain = F
    for low, high, label in AGE_BANDS:
        chain = chain.when((known >= low) & (known < high), label)
    return chain.otherwise(F.lit(None).cast("string"))


def risk_category(credit_score: Column) -> Column:
    chain = F
    for lowest, label in RISK_BANDS:
        chain = chain.when(credit_score >= lowest, label)
    return chain.otherwise(LOWEST_RISK_LABEL)


def signed_amount(transaction_type: Column, amount: Column, inflows: Sequence[str] = INFLOW_TYPES) -> Column:
    return F.when(transaction_type.isin(*inflows), amount).otherwise(-amount)


def describe_transaction(transaction_type: Column, merchant: Column) -> Column:
    """Leading words for the type, then the merchant; a type without words is used as it is."""
    pairs = [F.lit(x) for pair in DESCRIPTION_WORDS.items() for x in pair]
    words = F.coalesce(F.try_element_at(F.create_map(*pairs), transaction_type), transaction_type)
    return F.concat_ws(" ", words, merchant)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)
