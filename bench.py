"""Time the headline queries and print one JSON line.

Each query is built and run to completion twice into a sink that discards rows; the better run
counts, so start-up of the JVM is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldlens.queries import QUERIES  # noqa: E402

HEADLINE = [
    "first_five_report",
    "vip_outreach_report",
    "billing_status",
    "agents_on_shift",
    "first_five_shifts",
    "business_postings",
    "paid_history",
    "earlier_experience",
    "profile_flags",
    "badge_flags",
    "latest_notes",
    "sheet_rows",
    "sheet_sections",
    "late_clockins",
    "open_clockins",
    "pii_scan",
    "forbidden_phrases",
    "attribute_values",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.files.openCostInBytes", "1048576")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
            }
        )
    )


if __name__ == "__main__":
    main()
