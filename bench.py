"""Benchmark: the ten crash analyses at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line. Each analysis is run once
cold (first plan, JIT warm-up), then ``$BENCH_REPEAT`` times; the reported
time per query is the median of the warm runs, each a full ``collect``
of the result from the Parquet scan on. ``report_job_sec`` times the batch
report once, single pass: materialise the fixture's computed tables and the
shared distinct rows of units and person, run all ten (four at a time),
write the table results as CSV.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from crashlens.plans.registry import ANALYSIS_QUERIES  # noqa: E402
from crashlens.plans.report import run_report  # noqa: E402
from crashlens.session import build_session, scratch_path  # noqa: E402
from crashlens.sources.fixture import load_fixture  # noqa: E402

HEADLINE = [
    "a01_crashes_male_deaths",
    "a02_two_wheelers",
    "a03_top_makes_no_airbag",
    "a04_hit_and_run_licensed",
    "a05_state_non_female",
    "a06_makes_injury_rank_3_5",
    "a07_ethnicity_per_body",
    "a08_zips_alcohol",
    "a09_no_damage_high_severity",
    "a10_speeding_makes_top_colour_state",
]

LOGGED = {"a01": 1.64, "a02": 0.58, "a03": 1.54, "a04": 0.76, "a05": 1.80,
          "a06": 4.03, "a07": 6.78, "a08": 3.91, "a09": 2.70, "a10": 4.50}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app_name="crashlens-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    # JVM start-up and class loading belong to no query: a trivial job first.
    spark.range(100_000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name in HEADLINE:
        fn = ANALYSIS_QUERIES[name]
        t0 = time.perf_counter()
        fn(spark, sf_dir).collect()
        cold[name] = time.perf_counter() - t0
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).collect()
            runs.append(time.perf_counter() - t0)
        warm[name] = statistics.median(runs)
    # The whole batch job once: stage tables and shared distinct rows, run
    # all ten, write the six table results as CSV, collect the status rows.
    t0 = time.perf_counter()
    status = run_report(spark, load_fixture(spark, sf_dir, spread_to=cpus), scratch_path(spark, "bench-report"),
                        stage_tables=True, stage_distinct=True, parallelism=4).collect()
    report_s = time.perf_counter() - t0
    failed = [r.analysis for r in status if r.status != "success"]
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "crash_analyses_a01_a10_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {k[:3]: round(v, 3) for k, v in warm.items()},
        "cold_queries": {k[:3]: round(v, 3) for k, v in cold.items()},
        "cold_total": round(sum(cold.values()), 3),
        # The log is one pass, so the cold run is its fairer match.
        "cold_vs_log": {k[:3]: round(cold[k] / LOGGED[k[:3]], 2) for k in HEADLINE},
        "report_job_sec": round(report_s, 3),
        "report_job_failed": failed,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
