"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``, and their oracles.

Crash queries run on the fixture derived from the folder's ``lineitem``
and ``orders``; operator queries on the native tables. Source and sink
queries write the table once under the shared checkpoint folder and read
it back.
"""

from __future__ import annotations

from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.plans import analyses as A
from crashlens.plans import variants as V
from crashlens.plans.operator_queries import OPERATOR_QUERIES, OPERATOR_SQL
from crashlens.plans.oracles import ANALYSES_SQL, FIX, VARIANTS_SQL
from crashlens.plans.report import TABLE_ANALYSES, all_counts, run_report
from crashlens.plans.shared_scan import share
from crashlens.session import scratch_path
from crashlens.sources.catalog import CrashTables, read_csv_inferred, read_csv_typed, read_tables, stage
from crashlens.sources.csv_load import load_csv, read_csv_mixed
from crashlens.sources.fixture import load_fixture
from crashlens.sources.infer import read_csv_safe_inferred
from crashlens.sources.sink import read_result, write_csv
from crashlens.sources.sorted_sink import in_order, read_sorted, write_sorted
from crashlens.sources.stage_store import StageStore, load_tables

Query = Callable[[SparkSession, str], DataFrame]


def _fixture(spark: SparkSession, sf_dir: str) -> CrashTables:
    """The crash tables, their single-split sources dealt to as many partitions as there are cores."""
    return load_fixture(spark, sf_dir, spread_to=spark.sparkContext.defaultParallelism)


def _streamed_fixture(spark: SparkSession, sf_dir: str) -> CrashTables:
    """The crash tables for queries that first write them row by row: dealt out only if the sources' splits are few or uneven."""
    return load_fixture(spark, sf_dir, spread_to=spark.sparkContext.defaultParallelism, streamed=True)


def _on_fixture(fn: Callable[[CrashTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_fixture(spark, sf_dir))

    run.__doc__ = fn.__doc__
    return run


# name -> CrashTables -> DataFrame (the analyses with their report parameters)
ANALYSIS_FUNCTIONS: dict[str, Callable[[CrashTables], DataFrame]] = {
    "a01_crashes_male_deaths": A.a01_crashes_male_deaths,
    "a02_two_wheelers": A.a02_two_wheelers,
    "a03_top_makes_no_airbag": A.a03_top_makes_no_airbag,
    "a03_top_makes_no_airbag_counts": partial(A.a03_top_makes_no_airbag, with_counts=True),
    "a04_hit_and_run_licensed": A.a04_hit_and_run_licensed,
    "a05_state_non_female": A.a05_state_non_female,
    "a05_state_non_female_counts": partial(A.a05_state_non_female, with_counts=True),
    "a06_makes_injury_rank_3_5": A.a06_makes_injury_rank_3_5,
    "a07_ethnicity_per_body": A.a07_ethnicity_per_body,
    "a08_zips_alcohol": A.a08_zips_alcohol,
    "a08_zips_alcohol_counts": partial(A.a08_zips_alcohol, with_counts=True),
    "a09_no_damage_high_severity": A.a09_no_damage_high_severity,
    "a10_speeding_makes_top_colour_state": A.a10_speeding_makes_top_colour_state,
    "a10_speeding_makes_top_colour_state_counts": partial(A.a10_speeding_makes_top_colour_state, with_counts=True),
}
VARIANT_FUNCTIONS: dict[str, Callable[[CrashTables], DataFrame]] = {name: getattr(V, name) for name in VARIANTS_SQL}

ANALYSIS_QUERIES: dict[str, Query] = {name: _on_fixture(fn) for name, fn in ANALYSIS_FUNCTIONS.items()}
VARIANT_QUERIES: dict[str, Query] = {name: _on_fixture(fn) for name, fn in VARIANT_FUNCTIONS.items()}

# Column types of the native tables written to CSV and read back.
PART_TYPES = {"p_partkey": T.LongType(), "p_size": T.IntegerType(), "p_retailprice": T.DoubleType()}


# How CSV copies of the crash tables are written: packed, in files of a bounded number of rows, as a packed file is one split.
COPY = {"header": True, "compression": "lz4", "maxRecordsPerFile": 1 << 20}


def src_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` through a headed CSV and back, typed by column name."""
    path = scratch_path(spark, "part-csv")
    write_csv(spark.read.parquet(f"{sf_dir}/part.parquet"), path, files=None)
    return read_csv_typed(spark, path, PART_TYPES)


def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` through a headed CSV and back, with schema inference."""
    path = scratch_path(spark, "nation-csv")
    write_csv(spark.read.parquet(f"{sf_dir}/nation.parquet"), path, files=None)
    return read_csv_inferred(spark, path)


def src_csv_safe_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons through a headed CSV and back with inferred types: zips keep their zeros, counts become numbers."""
    path = scratch_path(spark, "persons-csv")
    _fixture(spark, sf_dir).person.write.options(**COPY).csv(path)
    return read_csv_safe_inferred(spark, path).select("UNIT_NBR", "DRVR_ZIP", "DEATH_CNT", "PRSN_GNDR_ID")


def src_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` from one folder of CSV files with three headers: all columns, another order, one column less."""
    path = scratch_path(spark, "part-mixed-csv")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    for i, columns in enumerate((part.columns, part.columns[::-1], [c for c in part.columns if c != "p_size"])):
        write_csv(part.filter(F.col("p_partkey") % 3 == i).select(*columns), path, files=None, mode="append")
    return read_csv_mixed(spark, path, PART_TYPES).select(*part.columns)


def src_csv_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as CSV text in which some records have a bad number, a field too few or one too many: good rows, and bad ones raw."""
    path = scratch_path(spark, "part-faulty-csv")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_size")
    size = F.when(F.col("p_partkey") % 7 == 3, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", size)
    line = F.when(F.col("p_partkey") % 11 == 5, F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name")).otherwise(line)
    line = F.when(F.col("p_partkey") % 13 == 1, F.concat(line, F.lit(",extra"))).otherwise(line)
    # A column that is named as the header, without quoting, writes lines as they are.
    part.select(line.alias(",".join(part.columns))).write.options(header=True, sep="\u0001", quote="").csv(path)
    load = load_csv(spark, path, PART_TYPES)
    good = load.rows.select("p_partkey", "p_name", "p_size", F.lit(None).cast("string").alias("raw"))
    bad = load.rescued.select(F.lit(None).cast("long").alias("p_partkey"), F.lit(None).cast("string").alias("p_name"),
                              F.lit(None).cast("int").alias("p_size"), F.col("_raw").alias("raw"))
    return good.unionByName(bad)


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07's result (body styles with commas) written as one CSV file and read back."""
    path = scratch_path(spark, "a07-csv")
    write_csv(A.a07_ethnicity_per_body(_fixture(spark, sf_dir)), path, files=1)
    return read_result(spark, path)


def sink_csv_null_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column with NULLs (driver zips) through the sink and back: no row is lost."""
    path = scratch_path(spark, "zips-csv")
    write_csv(_fixture(spark, sf_dir).person.select("DRVR_ZIP"), path, files=None)
    return read_result(spark, path)


def sink_sorted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` by status and date, descending, in many files and back; ``ordered`` says whether the files follow each other."""
    path = scratch_path(spark, "orders-sorted")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    manifest = write_sorted(orders, path, ["o_orderstatus", "o_orderkey"], descending=True)
    ordered = in_order(manifest, descending=True)
    return read_sorted(spark, path, {"o_orderkey": T.LongType()}).drop("_file").withColumn("ordered", F.lit(ordered))


def src_stage_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A08 on CSV folders of which a store had staged all but the files that came later."""
    store = StageStore(spark, scratch_path(spark, "store"))
    fixture, paths = _streamed_fixture(spark, sf_dir).as_dict(), {}
    for late in (False, True):
        for name, df in fixture.items():
            paths.setdefault(name, scratch_path(spark, f"{name}-csv"))
            part = df.filter((F.col("CRASH_ID") % 5 == 0) == F.lit(late))
            part.write.mode("append").options(**COPY).csv(paths[name])
        tables, _ = load_tables(store, paths)
    return A.a08_zips_alcohol(tables, with_counts=True)


def src_named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three crash tables as CSV folders, read by name, answering A08 with counts."""
    paths = {name: scratch_path(spark, f"{name}-csv") for name in ("person", "units", "damages")}
    for name, df in _streamed_fixture(spark, sf_dir).as_dict().items():
        df.write.options(**COPY).csv(paths[name])
    return A.a08_zips_alcohol(read_tables(spark, paths), with_counts=True)


def src_staged_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07 on staged tables and staged distinct rows."""
    return A.a07_ethnicity_per_body(stage(spark, _fixture(spark, sf_dir), with_distinct=True))


def src_shared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count analyses on groups that one pass over each table made."""
    return all_counts(share(spark, _fixture(spark, sf_dir)))


def report_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch report: what became of each analysis, and how many rows it wrote."""
    status = run_report(spark, _streamed_fixture(spark, sf_dir), scratch_path(spark, "report"))
    return status.select("analysis", "kind", "status", "n")


def report_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_counts(_fixture(spark, sf_dir))


SOURCE_QUERIES: dict[str, Query] = {
    "src_csv_typed": src_csv_typed,
    "src_csv_inferred": src_csv_inferred,
    "src_csv_safe_inferred": src_csv_safe_inferred,
    "src_csv_mixed_headers": src_csv_mixed_headers,
    "src_csv_rescued": src_csv_rescued,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_csv_null_roundtrip": sink_csv_null_roundtrip,
    "sink_sorted_roundtrip": sink_sorted_roundtrip,
    "src_stage_store": src_stage_store,
    "src_named_tables": src_named_tables,
    "src_staged_distinct": src_staged_distinct,
    "src_shared_scan": src_shared_scan,
    "report_all_counts": report_all_counts,
    "report_status": report_status,
}


def _report_sql() -> str:
    parts = []
    for name in ("a01_crashes_male_deaths", "a02_two_wheelers", "a04_hit_and_run_licensed",
                 "a09_no_damage_high_severity"):
        body = ANALYSES_SQL[name][len(FIX):]
        parts.append(f"SELECT '{name}' AS analysis, n FROM ({FIX} {body}) q_{name[:3]}")
    return " UNION ALL ".join(parts)


def _status_sql() -> str:
    parts = [f"SELECT analysis, 'count' AS kind, 'success' AS status, n FROM ({_report_sql()}) counts"]
    for name in TABLE_ANALYSES:
        body = ANALYSES_SQL[name][len(FIX):]
        parts.append(f"SELECT '{name}' AS analysis, 'table' AS kind, 'success' AS status, count(*) AS n FROM ({FIX} {body}) q_{name[:3]}")
    return " UNION ALL ".join(parts)


SOURCE_SQL: dict[str, str] = {
    "src_csv_typed": "SELECT * FROM part",
    "src_csv_inferred": "SELECT * FROM nation",
    "src_csv_safe_inferred": f"{FIX} SELECT CAST(UNIT_NBR AS INTEGER) AS UNIT_NBR, DRVR_ZIP, CAST(DEATH_CNT AS INTEGER) AS DEATH_CNT, PRSN_GNDR_ID FROM persons",
    "src_csv_mixed_headers": "SELECT * REPLACE (CASE WHEN p_partkey % 3 <> 2 THEN p_size END AS p_size) FROM part",
    "src_csv_rescued": """
        WITH t AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_partkey % 7 = 3 THEN 'many' ELSE CAST(p_size AS VARCHAR) END AS size FROM part),
        l AS (SELECT *, concat_ws(',', p_partkey, p_name, CASE WHEN p_partkey % 11 <> 5 THEN size END) AS line FROM t),
        m AS (SELECT *, CASE WHEN p_partkey % 13 = 1 THEN line || ',extra' ELSE line END AS raw FROM l)
        SELECT CASE WHEN good THEN p_partkey END AS p_partkey, CASE WHEN good THEN p_name END AS p_name,
               CASE WHEN good THEN p_size END AS p_size, CASE WHEN NOT good THEN raw END AS raw
        FROM (SELECT *, p_partkey % 7 <> 3 AND p_partkey % 11 <> 5 AND p_partkey % 13 <> 1 AS good FROM m) q
        WHERE NOT (p_partkey % 11 = 5 AND p_partkey % 13 = 1)
        UNION ALL SELECT NULL, NULL, NULL, raw FROM m WHERE p_partkey % 11 = 5 AND p_partkey % 13 = 1""",
    "sink_csv_roundtrip": ANALYSES_SQL["a07_ethnicity_per_body"],
    "sink_csv_null_roundtrip": f"{FIX} SELECT DRVR_ZIP FROM persons",
    "sink_sorted_roundtrip": "SELECT o_orderkey, o_orderstatus, o_orderpriority, true AS ordered FROM orders",
    "src_stage_store": ANALYSES_SQL["a08_zips_alcohol_counts"],
    "src_named_tables": ANALYSES_SQL["a08_zips_alcohol_counts"],
    "src_staged_distinct": ANALYSES_SQL["a07_ethnicity_per_body"],
    "src_shared_scan": _report_sql(),
    "report_all_counts": _report_sql(),
    "report_status": _status_sql(),
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(ANALYSIS_QUERIES)
    out.update(VARIANT_QUERIES)
    out.update(OPERATOR_QUERIES)
    out.update(SOURCE_QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(ANALYSES_SQL)
    out.update(VARIANTS_SQL)
    out.update({k: v.replace("@fixture", FIX, 1) if v.startswith("@fixture") else v for k, v in OPERATOR_SQL.items()})
    out.update(SOURCE_SQL)
    return out


def main(argv: list[str] | None = None) -> None:
    """Run or explain one registered query: ``KEY SF_DIR [--explain]``."""
    import argparse

    from crashlens.session import build_session

    parser = argparse.ArgumentParser(description="Run or explain one registered query.")
    parser.add_argument("key", choices=sorted(queries()))
    parser.add_argument("sf_dir")
    parser.add_argument("--explain", action="store_true", help="print the formatted physical plan instead")
    args = parser.parse_args(argv)
    spark = build_session()
    df = queries()[args.key](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    else:
        df.show(50, truncate=False)


if __name__ == "__main__":
    main()
