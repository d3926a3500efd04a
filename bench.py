"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed end to end with the ``noop`` sink (the whole plan runs,
nothing is collected); each is run BENCH_REPEATS times (default 3). ``queries`` and the
totals are medians; ``best`` has the best times and their totals. Prints ONE JSON line.

Optional: BENCH_EVENT_LOG=1 writes Spark's event log to a fresh folder under
/tmp (stage and task times for later reading) and adds the number of Spark jobs
per query to the JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadshift.plans.queries import QUERIES  # noqa: E402
from loadshift.session import get_session  # noqa: E402

# Queries that make up the headline number: the reference's own pipeline.
HEADLINE = ("compare_arms_onepass", "hourly_portfolio", "building_hour_compare", "peak_hour_slice",
            "annual_energy", "scenario_report", "scenario_sample", "sample_summary")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # keep the in-memory job/stage/SQL history small: the bench runs ~70 queries in one session
    extra = {"spark.driver.memory": "16g", "spark.ui.retainedJobs": "50", "spark.ui.retainedStages": "100",
             "spark.ui.retainedTasks": "1000", "spark.sql.ui.retainedExecutions": "20"}
    event_dir = None
    if os.environ.get("BENCH_EVENT_LOG"):
        event_dir = tempfile.mkdtemp(prefix="loadshift-events-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_session(f"local[{cpus}]", app_name="loadshift-bench", shuffle_partitions=int(cpus), extra=extra)
    tracker = spark.sparkContext.statusTracker()
    names = only or list(QUERIES)
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["distinct_ids"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    best: dict[str, float] = {}
    jobs: dict[str, int] = {}
    for name in names:
        times = []
        for _ in range(repeats):
            # collect garbage between queries (untimed), so one query's garbage is not
            # charged to the next
            spark.sparkContext._jvm.System.gc()
            before = len(tracker.getJobIdsForGroup(None))
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
            jobs[name] = len(tracker.getJobIdsForGroup(None)) - before
        timings[name], best[name] = round(statistics.median(times), 3), round(min(times), 3)
    head = [timings[q] for q in HEADLINE if q in timings]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    optional = {"spark_jobs": jobs, "event_log_dir": event_dir} if event_dir else {}
    print(json.dumps({
        "metric": "total_seconds_all_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "headline_seconds": round(sum(head), 3),
        "queries": timings,
        "best": {"value": round(sum(best.values()), 3),
                 "headline_seconds": round(sum(best[q] for q in HEADLINE if q in best), 3), "queries": best},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeats": repeats,
        **optional,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
