"""Reading the crash tables: named datasets, typed CSV, Parquet, staging.

``CrashTables`` is the unit every analysis takes. It is built once per job:
from CSV (typed by column name, or inferred on request), from Parquet, or
from the test fixture. ``stage`` writes the tables once as Parquet into the
shared checkpoint folder and reads them back, which (a) replaces repeated
CSV parsing by a columnar scan with filter pushdown and column pruning and
(b) cuts lineage, so a lost executor costs a re-read, not a re-parse.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.operators.distinct import ROW_HASH, by_copies, copies_map, distinct_rows, plain, row_hash
from crashlens.session import remove_path, scratch_path
from crashlens.sources.csv_load import read_csv_mixed
from crashlens.sources.schemas import REQUIRED_COLUMNS, TABLE_TYPES


@dataclass(frozen=True)
class CrashTables:
    """The three crash tables, optionally with their deduplicated forms.

    Several analyses work on distinct whole rows of ``units`` or ``person``.
    A batch job can stage those once (``stage(..., with_distinct=True)``);
    analyses then read the staged rows, column-pruned, instead of each
    shuffling every column for its own ``distinct()``.
    """

    person: DataFrame
    units: DataFrame
    damages: DataFrame
    person_rows: DataFrame | None = None  # distinct whole rows of person, if staged
    units_rows: DataFrame | None = None  # distinct whole rows of units, if staged
    staged_paths: tuple[str, ...] = ()  # folders that `stage` wrote for these tables
    tagged: dict[str, DataFrame] | None = None  # by table, groups that one pass over it made for several analyses

    def as_dict(self) -> dict[str, DataFrame]:
        return {"person": self.person, "units": self.units, "damages": self.damages}

    def distinct_person(self) -> DataFrame:
        return self.person_rows if self.person_rows is not None else self.person.distinct()

    def distinct_units(self) -> DataFrame:
        return self.units_rows if self.units_rows is not None else self.units.distinct()


def read_csv_typed(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None,
                   sep: str = ",") -> DataFrame:
    """Headed CSV; named columns cast to ``types``, the rest stay strings.

    Columns are matched by header name, so extra or reordered columns do no
    harm as long as all files below ``path`` have the same header; Spark
    stops with an error at a file that has another one (``read_csv_mixed``
    reads such folders). ``try_cast`` turns a malformed number into NULL
    instead of failing the job under ANSI mode (:func:`malformed_counts`
    counts them, ``load_csv`` keeps their records apart). The CSV reader prunes columns,
    so unused fields are never converted.
    """
    raw = _raw_csv(spark, path, sep)
    types = types or {}
    cols = [
        F.col(f"`{name}`").try_cast(types[name]).alias(name) if name in types else F.col(f"`{name}`")
        for name in raw.columns
    ]
    return raw.select(*cols)


def _raw_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.options(header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False).csv(path)


def malformed_counts(spark: SparkSession, path: str, types: dict[str, T.DataType], sep: str = ",") -> DataFrame:
    """``(column, n)``: values of each typed column that are there but that its type cannot hold."""
    raw = _raw_csv(spark, path, sep)
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).alias(c) for c, t in types.items() if c in raw.columns]
    counts = raw.agg(*bad)
    return counts.unpivot([], counts.columns, "column", "n")


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headed CSV with ``inferSchema``: an extra pass over the data, opt-in only."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "csv", infer: bool = False, mixed: bool = False) -> DataFrame:
    """Read one named crash table (``person``, ``units`` or ``damages``); ``mixed`` allows CSV files with different headers."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        typed = read_csv_mixed if mixed else read_csv_typed
        df = read_csv_inferred(spark, path) if infer else typed(spark, path, TABLE_TYPES.get(name))
    else:
        df = spark.read.format(fmt).load(path)
    missing = [c for c in REQUIRED_COLUMNS.get(name, ()) if c not in df.columns]
    if missing:
        raise ValueError(f"table {name!r} at {path} lacks columns {missing}")
    return df


def read_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "csv", infer: bool = False,
                mixed: bool = False) -> CrashTables:
    """Named dataset -> path mapping (the job's configuration) to tables."""
    return CrashTables(**{name: read_table(spark, name, paths[name], fmt, infer, mixed)
                          for name in ("person", "units", "damages")})


def stage(spark: SparkSession, tables: CrashTables, base: bool = True, with_distinct: bool = False,
          spread_to: int | None = None, announce: Callable[[str], None] | None = None) -> CrashTables:
    """Write tables once as Parquet in the shared folder; read them back.

    ``base`` stages the three input tables: worth it for CSV (parsed once
    instead of in every analysis, then read column-pruned), pointless for
    Parquet input. ``spread_to`` deals the input rows round-robin to so many
    partitions first, for a source that arrives as few splits (one gzip
    CSV); Spark sorts before that, so a retried task rebuilds the same
    partitions. ``with_distinct`` also stages the distinct whole rows of
    ``units`` and ``person``: one shuffle each of the rows' hashes and of the
    rows that may have copies, instead of one per analysis that deduplicates.
    With ``base`` the staged tables hold each row's hash, and the rows that occur once
    are read from there: only a map of the hashes that repeat and the distinct
    rows among those that may have copies are written. ``announce`` is told each
    folder before it is written. :func:`unstage` deletes what was written.
    """
    paths: list[str] = list(tables.staged_paths)

    def folder(name: str) -> str:
        path = scratch_path(spark, f"staged-{name.replace('_', '-')}")
        paths.append(path)
        if announce:
            announce(path)
        return path

    def written(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def write(name: str, df: DataFrame) -> DataFrame:
        return written(df, folder(name))

    def write_distinct(name: str, df: DataFrame) -> DataFrame:
        if ROW_HASH not in df.columns:
            return write(name, distinct_rows(df))
        path = folder(name)
        once, doubted = by_copies(df, written(copies_map(df), f"{path}/map"))
        return once.unionByName(written(doubted.distinct(), f"{path}/rows"))

    def write_all(frames: dict[str, DataFrame], write: Callable[[str, DataFrame], DataFrame] = write) -> dict[str, DataFrame]:
        # independent writes: submitted together so their stages overlap
        with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            futures = {name: pool.submit(write, name, df) for name, df in frames.items()}
            return {name: f.result() for name, f in futures.items()}

    try:
        frames = tables.as_dict()
        if base:
            frames = {name: df.repartition(spread_to) if spread_to else df for name, df in frames.items()}
            if with_distinct:
                frames |= {name: frames[name].withColumn(ROW_HASH, row_hash(frames[name])) for name in ("person", "units") if plain(frames[name])}
            frames = write_all(frames)
        if with_distinct:
            frames |= write_all({"person_rows": frames["person"], "units_rows": frames["units"]}, write_distinct)
            frames |= {name: frames[name].drop(ROW_HASH) for name in ("person", "units")}
    except BaseException:
        for path in paths[len(tables.staged_paths):]:
            remove_path(spark, path)
        raise
    return CrashTables(**frames, staged_paths=tuple(paths), tagged=tables.tagged)


def unstage(spark: SparkSession, tables: CrashTables) -> None:
    """Delete the folders that :func:`stage` wrote for ``tables``, which cannot be read after that."""
    for path in tables.staged_paths:
        remove_path(spark, path)
