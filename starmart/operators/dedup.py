"""Deduplication by aggregation.

A ``row_number`` window would bring all copies of a key into one task. ``max_by`` keeps only the best row so far,
on the map side too, so a key with a third of all rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

_PICK = "_pick"

#: Column to the aggregate of a group's rows and to what merges such aggregates.
Parts = dict[str, tuple[Column, Callable[[str], Column]]]


def _best_per_key(df: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias(_PICK))
    columns = {c: F.col(c) if c in keys else F.col(f"{_PICK}.`{c}`").alias(c) for c in df.columns}
    return packed.select(*[columns[c] for c in df.columns])


def _as_list(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def keep_last(df: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per key, the one with the largest ``order``; NULL keys form one group."""
    return _best_per_key(df, _as_list(keys), F.struct(*_as_list(order)), F.max_by)


def keep_first(df: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order``."""
    return _best_per_key(df, _as_list(keys), F.struct(*_as_list(order)), F.min_by)


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows, or distinct combinations of some columns."""
    return df.select(*columns).distinct() if columns else df.distinct()


def distinct_counts(df: DataFrame, by: str, counted: str, name: str) -> DataFrame:
    """Distinct non-NULL values per key, on two columns alone.

    A distinct count inside a wider aggregation makes Spark shuffle every aggregate once per (key, value) pair. Here
    only the pairs are shuffled, and grouping by the pair spreads a key with a third of all rows over its values.
    """
    pairs = df.where(F.col(counted).isNotNull()).select(by, counted).distinct()
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def grouped_with_distinct(
    df: DataFrame, by: str, counted: str, name: str, parts: Parts
) -> DataFrame:
    """Aggregates per key together with a distinct count, in one scan: grouped by (key, value) first, then by key.

    ``parts`` maps a column to the aggregate of its rows and to what merges such aggregates. The distinct count is then
    a count of rows, and a key with a third of all rows is spread over its values.
    """
    inner = df.groupBy(by, counted).agg(*[first.alias(c) for c, (first, _) in parts.items()])
    return inner.groupBy(by).agg(F.count(counted).alias(name), *[merge(c).alias(c) for c, (_, merge) in parts.items()])


def merged(partials: DataFrame, by: list[str], merges: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Aggregates per key from aggregates of some of its rows; columns keep their types."""
    kinds = {f.name: f.dataType for f in partials.schema.fields}
    return partials.groupBy(*by).agg(*[merge(c).cast(kinds[c]).alias(c) for c, merge in merges.items()])


def merged_with_distinct(partials: DataFrame, by: str, counted: str, name: str, merges: dict[str, Callable[[str], Column]]) -> DataFrame:
    """:func:`grouped_with_distinct` from aggregates by key and value, of which a pair may have several."""
    inner = merged(partials, [by, counted], merges)
    return inner.groupBy(by).agg(F.count(counted).alias(name), *[merge(c).alias(c) for c, merge in merges.items()])


def latest_version(dim: DataFrame, natural_key: str = "customer_id", version: str = "version") -> DataFrame:
    """The newest version of each natural key, current or not."""
    return keep_last(dim, natural_key, version)
