"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line with per-query wall seconds: one untimed
warm-up pass, then ``$BENCH_REPEATS`` (default 3) timed passes, median per query.  The
cache is cleared before every run and each query is executed to completion with the
``noop`` sink (no driver collection).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "cohort_sql",
    "los_overall",
    "subgroup_summary",
    "outlier_review",
    "pr_curve",
    "binary_metrics",
    "threshold_tuning",
    "calibration",
    "risk_tier",
    "split_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE)]
    from staylens.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="staylens-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from staylens.plans.registry import REGISTRY

    # warm-up pass, not timed: JVM JIT and Spark's generated-code cache
    for name in names:
        spark.catalog.clearCache()
        try:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception:  # the timed passes record the error
            pass
    runs: dict[str, list[float]] = {name: [] for name in names}
    errors: dict[str, str] = {}
    for _ in range(int(os.environ.get("BENCH_REPEATS", "3"))):
        for name in names:
            if name in errors:
                continue
            spark.catalog.clearCache()  # no query reuses another one's cached relations
            t0 = time.perf_counter()
            try:
                REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as exc:  # report and keep timing the others
                errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
                continue
            runs[name].append(time.perf_counter() - t0)
    timings = {name: round(statistics.median(v), 3) for name, v in runs.items() if v}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "headline_queries_median_wall_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))


if __name__ == "__main__":
    main()
