"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed, writing every row to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bodega.session import build_session
from checks.registry import QUERIES

HEADLINE = (
    "silver_ventas",
    "quality_report",
    "fact_ventas",
    "fact_inventario",
    "fact_devoluciones",
    "agg_ventas_diarias",
    "agg_devoluciones_categoria",
    "kpi_ejecutivo_diario",
    "rfm_metrics",
    "rfm_groups",
    "rfm_scores_distributed",
    "dq_results",
    "cluster_zorder",
    "raw_to_kpi",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bodega-bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=cpus,
        spark__sql__sources__parallelPartitionDiscovery__parallelism=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):  # the second run counts
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
