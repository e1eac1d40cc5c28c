"""An ordered result in many files: their names follow the order, and a manifest holds their bounds.

A result too large for one sorted file is dealt out by ranges of its sort key, sorted
within each range and written by all tasks at once. Reading the files by name is
reading the result in order, and a reader that wants one range of keys picks its
files from the manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.sources.sink import read_result, write_csv

DATA, MANIFEST = "data", "manifest"
_PLACE = "_sorted_place"


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], descending: bool = False, files: int | None = None) -> DataFrame:
    """Writes ``df`` ordered by ``keys`` as about ``files`` CSV files (as many as there are shuffle partitions) and their manifest; returns it.

    The manifest has a row per file: ``file`` (its name), ``n`` rows, and ``first`` and ``last``, the
    keys of its first and last row. NULL keys come first, or last if
    ``descending``. Rows with equal keys may lie in several files next to each other, so a
    key that most rows have does not make one large file. An existing folder is replaced.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(f"`{k}`").desc_nulls_last() if descending else F.col(f"`{k}`").asc_nulls_first() for k in keys]
    placed = df.withColumn(_PLACE, F.monotonically_increasing_id())
    by = [*order, F.col(_PLACE).asc()]
    ranged = placed.repartitionByRange(n, *by).sortWithinPartitions(*by).drop(_PLACE)
    write_csv(ranged, f"{path}/{DATA}", files=None)
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    back = read_result(df.sparkSession, f"{path}/{DATA}", types).select(F.col("_metadata.file_name").alias("file"), key.alias("key"))
    low, high = F.min("key"), F.max("key")
    bounds = back.groupBy("file").agg(F.count(F.lit(1)).alias("n"), (high if descending else low).alias("first"), (low if descending else high).alias("last"))
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")  # a row per file
    return read_manifest(df.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def in_order(manifest: DataFrame, descending: bool = False) -> bool:
    """Whether no file's keys go on before the file before it ends (a row per file comes to the driver)."""
    rows = manifest.orderBy("file").select("first", "last").collect()
    key = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    ends = [(key(r["first"]), key(r["last"])) for r in rows]
    if descending:
        return all(a >= b for a, b in ends) and all(x[1] >= y[0] for x, y in zip(ends, ends[1:]))
    return all(a <= b for a, b in ends) and all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))


def read_sorted(spark: SparkSession, path: str, types: dict | None = None) -> DataFrame:
    """The rows of :func:`write_sorted`, with ``_file``, by whose names the files follow each other."""
    raw = read_result(spark, f"{path}/{DATA}", types)
    return raw.select("*", F.col("_metadata.file_name").alias("_file"))
