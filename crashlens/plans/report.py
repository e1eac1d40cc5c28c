"""The batch report: run every analysis, write table results, report outcomes.

``all_counts`` is the lazy part: the four count analyses unioned into one
``(analysis, n)`` DataFrame. ``run_report`` is the job: it stages the input
tables once as Parquet in the shared folder, together with the distinct
rows of units and person that four analyses share, runs each analysis on
its own (one failure does not stop the others), writes table results as
CSV and returns one status row per analysis, errors included. Finished
analyses are committed beside the output, so a job whose driver was lost
goes on where it stopped (``commit_log``).

Command line (package shipped with ``--py-files``)::

    spark-submit --py-files crashlens.zip crashlens/plans/report.py --person P.csv \
        --units U.csv --damages D.csv --out /shared/reports [--format csv|parquet]
"""

from __future__ import annotations

import argparse
import os
import time
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.plans import analyses as A
from crashlens.plans.commit_log import CommitLog
from crashlens.plans.shared_scan import SHARED, share
from crashlens.sources.catalog import CrashTables, read_tables, stage, unstage
from crashlens.sources.sink import write_csv

# Analyses that give one number, in report order.
COUNT_ANALYSES = {
    "a01_crashes_male_deaths": A.a01_crashes_male_deaths,
    "a02_two_wheelers": A.a02_two_wheelers,
    "a04_hit_and_run_licensed": A.a04_hit_and_run_licensed,
    "a09_no_damage_high_severity": A.a09_no_damage_high_severity,
}
# Analyses that give a table: (function, output files; None = result size grows with input).
TABLE_ANALYSES = {
    "a03_top_makes_no_airbag": (A.a03_top_makes_no_airbag, 1),
    "a05_state_non_female": (A.a05_state_non_female, 1),
    "a06_makes_injury_rank_3_5": (A.a06_makes_injury_rank_3_5, None),
    "a07_ethnicity_per_body": (A.a07_ethnicity_per_body, 1),
    "a08_zips_alcohol": (A.a08_zips_alcohol, 1),
    "a10_speeding_makes_top_colour_state": (A.a10_speeding_makes_top_colour_state, 1),
}

# Analyses that work on distinct whole rows.
NEED_DISTINCT = {"a06_makes_injury_rank_3_5", "a07_ethnicity_per_body", "a08_zips_alcohol", "a10_speeding_makes_top_colour_state"}

STATUS_SCHEMA = T.StructType([
    T.StructField("analysis", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("n", T.LongType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("seconds", T.DoubleType(), True),
    T.StructField("error", T.StringType(), True),
])


def all_counts(t: CrashTables) -> DataFrame:
    """The count analyses as one lazy ``(analysis, n)`` DataFrame."""
    parts = [fn(t).select(F.lit(name).alias("analysis"), "n") for name, fn in COUNT_ANALYSES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _run_count(name: str, fn, t: CrashTables, log: CommitLog) -> tuple:
    start = time.time()
    try:
        n = fn(t).first()["n"]
        row = (name, "count", "success", int(n), str(n), None, time.time() - start, None)
        log.commit(name, dict(zip(STATUS_SCHEMA.names, row)))
        return row
    except Exception as err:  # reported as a row, the run goes on
        return (name, "count", "error", None, None, None, time.time() - start, _error_text(err))


def _run_table(name: str, fn, files: int | None, t: CrashTables, log: CommitLog) -> tuple:
    start = time.time()
    path = _output(log.folder, name)
    try:
        n = log.write(name, path, lambda folder: write_csv(fn(t), folder, files=files))
        row = (name, "table", "success", n, None, path, time.time() - start, None)
        log.commit(name, dict(zip(STATUS_SCHEMA.names, row)))
        return row
    except Exception as err:
        return (name, "table", "error", None, None, path, time.time() - start, _error_text(err))


def _output(folder: str, name: str) -> str:
    return os.path.join(folder, f"{name}.csv")


def run_report(spark: SparkSession, t: CrashTables, out_dir: str, stage_tables: bool = True,
               stage_distinct: bool = True, parallelism: int = 4, retries: int = 1,
               pool: str | None = None, spread_to: int | None = None, run_id: str | None = None,
               shared_scan: bool = True) -> DataFrame:
    """Run all ten analyses; return one status row per analysis.

    ``run_id`` names the input and its version. A job that finds analyses
    committed in ``out_dir`` under the same ``run_id`` takes their status from
    there and runs the rest; failed analyses are not committed. Whatever else
    an earlier job left (outputs without a commit, attempts, staged tables,
    commits of other runs) is removed first. Without a ``run_id`` every job
    starts anew. One job at a time may write to ``out_dir``.

    ``stage_tables`` writes the inputs once as Parquet (for CSV input, or
    computed tables); ``shared_scan`` makes the first groups of A01-A05 and A09
    from one pass per table; ``stage_distinct`` writes the distinct rows of units
    and person once, shared by A06, A07, A08 and A10. The analyses are
    independent Spark jobs; up to ``parallelism`` of them are submitted at
    once from driver threads, so the scheduler can overlap their stages
    (use a FAIR pool on a shared cluster). Status rows come back in report
    order whatever the completion order. A table result's rows are in the
    files its ``path`` names, and ``n`` counts the rows that were written.
    What was staged is deleted at the end, also after a failure.
    """
    given = t
    log = CommitLog(spark, out_dir, run_id or uuid.uuid4().hex)
    done = log.recover({name: _output(log.folder, name) for name in TABLE_ANALYSES})
    todo = [name for name in (*COUNT_ANALYSES, *TABLE_ANALYSES) if name not in done]
    if todo and (stage_tables or stage_distinct):
        t = stage(spark, t, base=stage_tables, with_distinct=stage_distinct and bool(NEED_DISTINCT & set(todo)), spread_to=spread_to,
                  announce=log.staging)
    if shared_scan and SHARED & set(todo):
        try:
            t = share(spark, t, announce=log.staging)
        except Exception:  # the analyses then scan by themselves, and the one at fault reports it
            pass
    jobs = [partial(_run_count, name, COUNT_ANALYSES[name], t, log) for name in COUNT_ANALYSES if name in todo]
    jobs += [partial(_run_table, name, *TABLE_ANALYSES[name], t, log) for name in TABLE_ANALYSES if name in todo]

    def attempt(job) -> tuple:
        # Jobs carry the analysis name (event log, UI on a cluster) and, if
        # given, run in a FAIR scheduler pool; both are per-thread properties.
        sc = spark.sparkContext
        sc.setJobDescription(f"crashlens {job.args[0]}")
        if pool:
            sc.setLocalProperty("spark.scheduler.pool", pool)
        # Spark already retries tasks and stages; an analysis that still fails
        # (e.g. repeated executor loss) is run once more. Outputs are written
        # with overwrite, so a re-run is idempotent.
        row = job()
        for _ in range(retries):
            if row[2] == "success":
                break
            row = job()
        return row

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as executor:
            ran = {row[0]: row for row in executor.map(attempt, jobs)}
    finally:
        if t is not given:
            unstage(spark, t)
    log.finish()
    kept = {name: tuple(status[c] for c in STATUS_SCHEMA.names) for name, status in done.items()}
    rows = [(kept | ran)[name] for name in (*COUNT_ANALYSES, *TABLE_ANALYSES)]
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def _error_text(err: Exception) -> str:
    return "".join(traceback.format_exception_only(type(err), err)).strip()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the crash analyses and write the report.")
    parser.add_argument("--person", required=True)
    parser.add_argument("--units", required=True)
    parser.add_argument("--damages", required=True)
    parser.add_argument("--out", required=True, help="shared output folder")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--infer-schema", action="store_true")
    parser.add_argument("--mixed-headers", action="store_true", help="the files of a CSV folder may have different headers")
    parser.add_argument("--spread-to", type=int, default=None, help="partitions to deal staged input rows to")
    parser.add_argument("--parallelism", type=int, default=4, help="analyses submitted at once")
    parser.add_argument("--run-id", default=None, help="name of the input's version; a job with the same name goes on where the last one stopped")
    parser.add_argument("--pool", default=None, help="FAIR scheduler pool for the analyses' jobs")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("crashlens-report").getOrCreate()
    tables = read_tables(spark, {"person": args.person, "units": args.units, "damages": args.damages},
                         fmt=args.format, infer=args.infer_schema, mixed=args.mixed_headers)
    status = run_report(spark, tables, args.out, stage_tables=args.format == "csv", parallelism=args.parallelism,
                        pool=args.pool, spread_to=args.spread_to, run_id=args.run_id)
    status.write.mode("overwrite").json(os.path.join(args.out, "_report"))
    status.show(truncate=False)


if __name__ == "__main__":
    main()
