"""Sharding by sampled splitters.

A size-weighted sample of the keys is drawn, its quantiles cut the key space into ranges, ranges that turn out overfull
are sampled again and subdivided, and the rows of each range are numbered in key order. Exact totals of the ranges then
place every row on one line of bytes, which is cut into equal shards.

The key is a pair: `major` (here a hash of the text, so equal texts lie together) and `minor` (the document id, so a
group of copies of any size can still be cut). Only the sample and the totals of the ranges reach the driver; both are
bounded by the number of ranges.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import carry_modules

#: Expected sampled keys per range.
SAMPLES = 16
#: Ranges per shard, and rows that a range should hold at least and at most on average.
RANGES_PER_SHARD, LEAST_ROWS, MOST_ROWS = 64, 16, 1_000_000
#: A range of more than so many times the mean size, and of more rows than LEAST_ROWS, is subdivided.
OVERFULL = 2.0
_LEAST = -(1 << 63)


def _sample(rows: DataFrame, step: float, salt: int) -> list[tuple[int, int]]:
    """Keys drawn with a chance of size / step; the draw is a hash of the key, so a lost task draws the same."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(salt), "major", "minor"), 11) / F.lit(float(1 << 53))
    return [(r[0], r[1]) for r in rows.where(draw < F.col("size") / F.lit(float(step))).select("major", "minor").collect()]


def _quantiles(keys: list[tuple[int, int]], parts: int) -> list[tuple[int, int]]:
    keys = sorted(keys)
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def _range_number(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below a row's key."""
    major = np.array([k[0] for k in splitters], np.int64)
    minor = np.array([k[1] for k in splitters], np.int64)

    @F.pandas_udf("int")
    def number(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            a, b = a.to_numpy(np.int64), b.to_numpy(np.int64)
            low, high = np.searchsorted(major, a, "left"), np.searchsorted(major, a, "right")
            for value in np.unique(a[low < high]):  # keys that share their first part with a splitter
                rows = np.flatnonzero(a == value)
                first, last = low[rows[0]], high[rows[0]]
                low[rows] = first + np.searchsorted(minor[first:last], b[rows], "right")
            yield pd.Series(low.astype(np.int32))

    return number(F.col("major"), F.col("minor"))


def _totals(rows: DataFrame, splitters: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    held = rows.groupBy(_range_number(splitters).alias("range")).agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    return {r["range"]: (r["s"], r["n"]) for r in held.collect()}


def find_splitters(rows: DataFrame, ranges: int, total: int, rounds: int = 8):
    """Splitters of `rows` (major, minor, size) and the exact (bytes, rows) of the ranges between them."""
    step = max(1.0, total / (ranges * SAMPLES))
    splitters = _quantiles(_sample(rows, step, 0), ranges)
    held = _totals(rows, splitters)
    for again in range(1, rounds + 1):
        mean = total / max(1, ranges)
        full = {r: s for r, (s, n) in held.items() if s > OVERFULL * mean and n > LEAST_ROWS}
        if not full:
            break
        inside = rows.where(_range_number(splitters).isin(list(full)))
        finer = step / 2 ** again
        keys: dict[int, list[tuple[int, int]]] = {}
        for key in _sample(inside, finer, again):
            keys.setdefault(bisect_right(splitters, key), []).append(key)
        more = set(splitters)
        for r, own in keys.items():
            more.update(_quantiles(own, 1 + int(np.ceil(full.get(r, mean) / mean)) * 2))
        if len(more) == len(splitters):
            continue
        splitters = sorted(more)
        held = _totals(rows, splitters)
    return splitters, held


def shard(df: DataFrame, shards: int = 24, *, size: str = "size", major: str, minor: str) -> DataFrame:
    """`df` with `shard` (0 to shards - 1, near equal bytes) and `slot` (gapless from 0 inside the shard).

    `major` and `minor` are long columns; NULL sorts first. A row of any size stays whole, so shards differ by at most
    about one row's bytes from the mean. Rows of equal keys are interchangeable; they get distinct slots. `df` is read
    several times: stage it if it is costly. Columns named shard and slot are replaced. An empty table gives an empty table.
    """
    carry_modules(df.sparkSession)
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(F.col(major), F.lit(_LEAST)).alias("major"), F.coalesce(F.col(minor), F.lit(_LEAST)).alias("minor"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"),
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    ranges = max(1, min(RANGES_PER_SHARD * shards, count // LEAST_ROWS), count // MOST_ROWS)
    splitters, held = find_splitters(rows, ranges, total)
    lines, bytes_so_far, rows_so_far = [], 0, 0
    for r in range(len(splitters) + 1):
        s, n = held.get(r, (0, 0))
        lines.append((r, bytes_so_far, rows_so_far))
        bytes_so_far, rows_so_far = bytes_so_far + s, rows_so_far + n
    before = spark.createDataFrame(lines, "range int, bytes_before long, rows_before long")
    # the row travels whole, so that its columns may have any names
    keyed = df.select(
        F.struct(*df.columns).alias("row"), F.coalesce(F.col(major), F.lit(_LEAST)).alias("major"),
        F.coalesce(F.col(minor), F.lit(_LEAST)).alias("minor"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    keyed = keyed.withColumn("range", _range_number(splitters))
    order = Window.partitionBy("range").orderBy("major", "minor", "size")
    line = keyed.withColumn("n", F.row_number().over(order)).withColumn(
        "cut", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # bounded by the number of ranges, whose totals find_splitters has had in the driver
    line = line.join(F.broadcast(before), "range")
    place = F.floor((F.col("bytes_before") + F.col("cut") - F.col("size") / 2) * F.lit(shards) / F.lit(max(1, total)))
    line = line.withColumn("shard", F.least(F.lit(shards - 1), F.greatest(F.lit(0), place)).cast("int"))
    line = line.withColumn("index", F.col("rows_before") + F.col("n") - 1)
    first = line.groupBy("shard").agg(F.min("index").alias("first"))
    own = [F.col("row")[c].alias(c) for c in df.columns if c not in ("shard", "slot")]
    # one row for each shard
    return line.join(F.broadcast(first), "shard").select(*own, "shard", (F.col("index") - F.col("first")).alias("slot"))


def keyed_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_hash): what sharding needs to know of each document."""
    carry_modules(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).cast("long").alias("text_crc32"), F.xxhash64(body).alias("text_hash"),
    )
