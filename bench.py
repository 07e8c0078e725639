"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Every query runs whole and all its
columns are computed (the no-op sink takes them); the first run of each warms up, the better of
two more counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from lakequality import get_session
from lakequality.plans import catalogue

HEADLINE = [
    "parse_order_payload",
    "parse_event_payload",
    "bronze_with_fields",
    "quality_single_table",
    "quality_readings",
    "rule_failure_counts",
    "quality_trend",
    "top_failure_reasons",
    "dq_duplicates",
    "dedup_latest",
    "incremental_unprocessed",
    "upsert_merge",
    "enrich_master",
    "fragment_concat",
    "paged_batches",
    "hourly_throughput",
    "mask_pii",
    "stream_bronze_to_silver",
    "stream_customer_counts",
]
# Queries whose rows per second the targets speak of, with the table that feeds them.
RATED = {
    "parse_order_payload": "lineitem",
    "quality_single_table": "lineitem",
    "stream_bronze_to_silver": "events",
}


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds, rates = {}, {}
    for name in wanted:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
        if name in RATED:
            rows = spark.read.parquet(f"{sf_dir}/{RATED[name]}.parquet").count()
            rates[name] = round(rows / seconds[name])
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": rates,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
