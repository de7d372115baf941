"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per query (the best one
counts). Each run plans the query anew and writes every result row to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from starmart.session import get_session  # noqa: E402

HEADLINE = (
    "v_churn_risk", "v_cross_sell_affinity", "v_monthly_revenue", "customer_features", "churn_features",
    "cross_sell_features", "customer_snapshot", "product_performance", "regional_analysis", "fraud_features",
    "running_balance", "facts_transform", "scd2_apply", "dq_config_run", "load_incremental",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("starmart-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
