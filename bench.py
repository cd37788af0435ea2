"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma separated, default the headline list).  Each query is run once to
warm up; the better of two further runs counts.  The whole result is computed each time.
"""

from __future__ import annotations

import json
import os
import time

from sensorgrid.plans.catalog import QUERIES
from sensorgrid.session import local_session

HEADLINE = [
    "clean_panel",
    "impute",
    "impute_spatial_available",
    "dense_panel",
    "dedup_last",
    "resample",
    "training_windows",
    "snapshot_agg",
    "align_to_nodes",
    "monotone_buckets",
    "scan_nested_history",
    "graph_norm_symmetric",
    "forecast_metrics",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    times = {}
    for name in names.split(",") if names else HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
