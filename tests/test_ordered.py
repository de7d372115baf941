import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import ordered

SCHEMA = "sk long, c long, at timestamp_ntz, v decimal(15,2)"


def make_rows(seed=7, n=400):
    """One customer holds most rows; many rows share a time and some have none."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for sk in range(n):
        at = start + dt.timedelta(minutes=rng.randrange(0, 3000, 20)) if rng.random() > 0.05 else None
        rows.append((sk, 1 if rng.random() < 0.7 else rng.randrange(2, 6), at, Decimal(rng.randrange(-5000, 5000)) / 100))
    return rows


def by_customer(rows):
    late = dt.datetime.max
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2] or late, r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("runs", [None, 1, 7, 60])
def test_previous_value_against_brute_force(spark, runs):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.sk: r.prev for r in ordered.with_previous(df, "c", "at", "sk", "prev", runs).collect()}
    want = {r[0]: (rs[i - 1][2] if i else None) for rs in by_customer(rows).values() for i, r in enumerate(rs)}
    assert got == want


@pytest.mark.parametrize("runs", [None, 1, 60])
def test_running_sum_against_brute_force(spark, runs):
    rows = make_rows(11)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.sk: r.total for r in ordered.with_running_sum(df, "c", "at", "sk", F.col("v"), "total", runs).collect()}
    want = {}
    for rs in by_customer(rows).values():
        total = Decimal(0)
        for r in rs:
            total += r[3]
            want[r[0]] = total
    assert got == want


def test_running_sum_of_missing_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 1L, 5, NULL), (2L, 1L, 6, 2), (3L, 1L, 7, NULL), (4L, 1L, NULL, 3) t(sk, c, at, v)")
    for runs in (1, 4):
        got = {r.sk: r.total for r in ordered.with_running_sum(df, "c", "at", "sk", F.col("v").cast("decimal(9,2)"), "total", runs).collect()}
        assert got == {1: None, 2: 2, 3: 2, 4: 5}


@pytest.mark.parametrize("runs", [1, 9])
def test_positions(spark, runs):
    rows = [(None, 3), (None, 1), (1, None), (1, 2), (1, 2), (2, 5)] + [(7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, o int")
    got = sorted(((r.k, r.o, r.at) for r in ordered.with_position(df, "k", ["o"], "at", runs).collect()), key=repr)
    want = [(None, 1, 0), (None, 3, 1), (1, 2, 0), (1, 2, 1), (1, None, 2), (2, 5, 0)] + [(7, i, i) for i in range(200)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("empty", [True, False])
def test_one_moment_of_one_key_is_cut(spark, empty):
    """Rows of one key without a time, or all of one time, lie in many runs, and no run is long."""
    time = F.lit(None).cast("timestamp_ntz") if empty else F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    df = spark.range(4000).select(F.col("id").alias("sk"), F.lit(1).alias("c"), time.alias("at"))
    rows = ordered.in_runs(df, "c", ["at", "sk"], 16)
    sizes = [r["count"] for r in rows.groupBy(ordered.RUN).count().collect()]
    assert len(sizes) > 12 and max(sizes) < 800
    got = ordered.with_position(df, "c", ["at", "sk"], "n", 16)
    assert got.where("n <> sk").count() == 0 and got.count() == 4000


def test_rows_are_clustered_by_run(spark):
    """No window may cluster the rows on the key alone, and only carry rows are broadcast."""
    df = spark.createDataFrame(make_rows(), SCHEMA)
    plan = ordered.with_previous(df, "c", "at", "sk", "prev", 8)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    alone = [line for line in exchanges if re.search(r"hashpartitioning\(c#\d+L, \d", line)]
    assert len(alone) == 1  # the carries: a row per run and key
    assert any(re.search(r"hashpartitioning\(_run#\d+, c#", line) for line in exchanges)


@pytest.mark.parametrize("runs", [1, 12])
def test_as_of_against_brute_force(spark, runs):
    rng = random.Random(5)
    versions = [(c, d, f"v{c}-{d}") for c in (1, 2, 3) for d in sorted(rng.sample(range(0, 100, 5), 9))] + [(None, 1, "x"), (1, None, "y")]
    events = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([*range(-3, 110), None])) for i in range(300)]
    got = ordered.as_of(
        spark.createDataFrame(events, "id long, c int, at int"), spark.createDataFrame(versions, "c int, since int, name string"),
        "c", "at", "since", ["name"], runs)
    assert got.columns == ["id", "c", "at", "name"]
    for r in got.collect():
        known = [v for v in versions if r.c is not None and r.at is not None and v[0] == r.c and v[1] is not None and v[1] <= r.at]
        assert r.name == (max(known)[2] if known else None), r
    assert got.count() == 300
