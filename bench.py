"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores.  Each query runs three times
into a sink that computes every row and keeps none; the median counts.
"""

import json
import os
import re
import statistics
import time

from devpulse.registry import QUERIES
from devpulse.session import local_session

HEADLINE = [
    "adoption_a",
    "adoption_b",
    "activity_yearly",
    "technology_adoption",
    "said_vs_did",
    "technology_sentiment",
    "adoption_anomalies",
    "salary_by_stack",
    "dim_technologies",
    "unpivot_survey_a",
    "monthly_events",
    "load_wide_survey",
    "join_spine",
    "check_unique_combination",
    "quality_dashboard",
    "parse_check_log",
    "describe_numeric",
    "null_report",
    "role_skills_compare",
    "adoption_trend",
]
REPEATS = 3


def shuffled(spark) -> int:
    """Bytes written to shuffles so far."""
    store = spark.sparkContext._jsc.sc().statusStore()
    return store.executorSummary("driver").totalShuffleWrite()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds, shuffle_mb = {}, {}
    for name in HEADLINE:
        runs, before = [], shuffled(spark)
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        shuffle_mb[name] = round((shuffled(spark) - before) / REPEATS / 1e6, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "shuffle_write_mb": shuffle_mb,
                "spark": spark.version,
                "cores": spark.sparkContext.defaultParallelism,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
