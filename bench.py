"""Wall time of the headline queries. Prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (3); the median counts. Those that write tables as they
go take seconds each: they run ``BENCH_WRITING_RUNS`` times (2) after everything is warm. Results go to Spark's ``noop``
sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import time

import pyspark

from driver_queries import QUERIES
from priceloom.session import local_session

HEADLINE = [
    "region_price_stats",
    "region_price_quartiles",
    "price_dispersion",
    "latest_price_map",
    "station_price_rank",
    "station_price_top10",
    "rank_all_events",
    "price_kpis",
    "dedup_keep_first",
    "dedup_first_lineitem",
    "surrogate_keys",
    "location_dim",
    "star_join",
    "fact_full_build",
    "dq_summary",
    "freshness_status",
]
WRITING = [
    "xml_parse_stats", "landed_archives", "bronze_roundtrip", "upsert_merge", "merge_with_removals", "incremental_build",
    "gated_build_ranking",
]


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    times = {}
    for name in HEADLINE:
        seconds(spark, folder, name)
        times[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(runs)), 3)
    again = int(os.environ.get("BENCH_WRITING_RUNS", "2"))
    for name in WRITING:
        times[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(again)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries: medians of three runs, of two for those that write tables",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": pyspark.__version__,
        "machine": platform.machine(),
    }))


if __name__ == "__main__":
    main()
