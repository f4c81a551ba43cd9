"""Headline queries, median of three runs after a warm-up; prints one JSON line.

The warm-up starts without cached tables and prepares the rule, group and location
look-ups; ``first_run`` gives its times, compilation included. The timed runs find the
look-ups in the cache, as the bundles of a production run do, but never any records.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = {
    "records": None,
    "rule_match": "rule_match_scale",
    "value_in_any_rule": "value_in_any_rule",
    "count_reconciliation": "count_reconciliation",
    "location_distance": "location_distance",
    "status_overview": "status_overview",
    "all_checks": "failures_by_section",
    "export": "export_projection",
}


def main() -> None:
    from tidegate.plans import sample_views
    from tidegate.plans.sample_queries import QUERIES
    from tidegate.runtime import build_session

    spark = build_session(
        app="bench",
        master=f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for label, name in HEADLINE.items():
        query = QUERIES[name] if name else sample_views.records
        seen = []
        spark.catalog.clearCache()
        for _ in range(RUNS + 1):
            start = time.time()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seen.append(time.time() - start)
        first[label] = round(seen[0], 3)
        times[label] = round(statistics.median(seen[1:]), 3)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "first_run": first,
        "records": lines,
        "records_per_sec": {k: round(lines / v) for k, v in times.items() if k != "status_overview"},
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
