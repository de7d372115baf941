"""Date and time expressions. All are plain Column builders, evaluated inside Spark."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_SECOND = 1_000_000

#: Inclusive bounds of a usable date key.
MIN_DATE_KEY, MAX_DATE_KEY = 19000101, 29991231


def as_of_timestamp(as_of: Column | dt.datetime | dt.date | str | None = None) -> Column:
    """The reference instant as a zone-less timestamp; the current local time when not given."""
    if as_of is None:
        return F.localtimestamp()
    value = as_of if isinstance(as_of, Column) else F.lit(str(as_of))
    return value.cast("timestamp_ntz")


def as_of_date(as_of: Column | dt.datetime | dt.date | str | None = None) -> Column:
    return F.to_date(as_of_timestamp(as_of))


def date_key(date: Column | str) -> Column:
    """``yyyymmdd`` as an int; NULL for a NULL date."""
    d = F.col(date) if isinstance(date, str) else date
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.try_to_date(k.cast("string"), "yyyyMMdd")


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def is_payday(date: Column) -> Column:
    return F.dayofmonth(date).isin(1, 15)


def fiscal_year(date: Column, first_month: int = 4) -> Column:
    return F.year(date) - F.when(F.month(date) < first_month, 1).otherwise(0)


def completed_years(birth: Column, at: Column) -> Column:
    """Whole years between two dates, cut towards zero."""
    return (F.months_between(at, birth) / 12).cast("int")


def elapsed_days(since: Column, at: Column) -> Column:
    """Fractional days; keeps the time of day of ``at``."""
    micros = F.timestamp_diff("MICROSECOND", since.cast("timestamp_ntz"), at.cast("timestamp_ntz"))
    return micros / F.lit(float(MICROS_PER_DAY))


def elapsed_seconds(since: Column, at: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", since, at) / F.lit(float(MICROS_PER_SECOND))


def tenure_months(opened: Column, at: Column) -> Column:
    return F.datediff(at, opened) / F.lit(30.0)


# --- fixed values: strptime directives and the datetime pattern letters that parse the same text -----------
STRPTIME_PATTERNS = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%I": "h", "%M": "m", "%S": "s", "%p": "a",
    "%f": "SSSSSS", "%j": "D", "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE", "%%": "%",
}
#: One-letter patterns take one or two digits; next to another number they must have a fixed width.
FIXED_WIDTH = {"M": "MM", "d": "dd", "H": "HH", "h": "hh", "m": "mm", "s": "ss", "D": "DDD"}
# ----------------------------------------------------------------------------------------------------------

_TOKEN = re.compile("(%.)|([^%]+)|(%$)")
_NUMERIC = set("yMdHhmsSD")


def spark_datetime_pattern(strptime_format: str) -> str:
    """Translate a strptime format into a Spark datetime pattern."""
    parts: list[str] = []
    numeric: list[bool] = []
    for directive, literal, dangling in _TOKEN.findall(strptime_format):
        if dangling or (directive and directive not in STRPTIME_PATTERNS):
            raise ValueError(f"unsupported directive {directive or dangling!r} in {strptime_format!r}")
        parts.append(STRPTIME_PATTERNS[directive] if directive else _quoted(literal))
        numeric.append(bool(directive) and len(parts[-1]) != 3 and parts[-1][0] in _NUMERIC and parts[-1] != "MMMM")
    for i, part in enumerate(parts):
        touches = (i > 0 and numeric[i - 1]) or (i + 1 < len(parts) and numeric[i + 1])
        if numeric[i] and touches:
            parts[i] = FIXED_WIDTH.get(part, part)
    return "".join(parts)


def _quoted(literal: str) -> str:
    return re.sub("[A-Za-z]+", lambda m: f"'{m.group()}'", literal.replace("'", "''"))
