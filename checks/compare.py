"""Compare the Spark queries with their SQL on one data folder: ``python -m checks.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

from checks.oracle import ORACLE
from checks.queries import QUERIES
from starmart.session import get_session

#: The given tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*(table.column(n).to_pylist() for n in names)), key=repr)


def _types(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(got: pa.Table, want: pa.Table) -> str | None:
    """What differs first: columns, types, row count or values; ``None`` when equal."""
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(set(got.column_names) ^ set(want.column_names))}"
    a, b = _types(got), _types(want)
    if a != b:
        return f"types {[(c, a[c], b[c]) for c in a if a[c] != b[c]]}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} <> {want.num_rows}"
    unlike = [(x, y) for x, y in zip(_rows(got), _rows(want)) if x != y]
    return f"{len(unlike)} rows differ, first {unlike[0]}" if unlike else None


def main(folder: str, names: list[str]) -> int:
    spark = get_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, folder).toArrow()
            spent = time.time() - start
            if name not in ORACLE:
                print(f"-    {name} {got.num_rows} rows {spent:.1f}s (no SQL)", flush=True)
                continue
            problem = difference(got, con.sql(ORACLE[name]).to_arrow_table())
        except Exception as error:
            problem, spent = str(error)[:1500], time.time() - start
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {got.num_rows if not problem else ''} {spent:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
