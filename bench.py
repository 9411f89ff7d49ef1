"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores. Each query is run to completion with all its columns,
once to warm up and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from sievework.catalog.queries import QUERIES

HEADLINE = [
    "qualified_leads",
    "qualified_leads_cached",
    "run_summary",
    "tier_scorecard",
    "sites_distinct",
    "page_text",
    "page_lookup",
    "website_requests",
    "answers_decoded",
    "website_scores",
    "profile_trimmed",
    "qualified_people",
    "weighted_leads",
    "rubric_evidence",
    "text_rows_scored",
    "cache_hits",
    "cache_misses",
    "checkpoint_leads",
    "job_progress",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    names = [n for n in HEADLINE if len(sys.argv) < 2 or n in sys.argv[1:]]
    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(timed(name), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
