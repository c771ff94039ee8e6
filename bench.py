"""Headline queries at one scale; prints one JSON line.

Median of three runs after a warm-up, each run writing the full result to a sink
that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfmark.plans.queries import QUERIES  # noqa: E402
from shelfmark.session import build_session, run_folder  # noqa: E402

HEADLINE = (
    "parse_size_a",
    "parse_size_b",
    "stage_feed_a",
    "dedup_keep_first",
    "changed_products",
    "scd2_load",
    "mart_sync",
    "html_extract_fields",
    "html_extract_links",
    "ready_files",
    "log_update",
    "check_fk",
    "csv_roundtrip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        with run_folder(spark, "bench"):  # what a query writes goes when it ends
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
