"""CSV folders whose files differ in their headers or hold bad records.

Files are grouped by their header line (a column added, taken away or moved
makes another group); each group is read by its own header and the groups are
united by column name. :func:`load_csv` parses once: rows that hold a value
their column's type cannot take, or too many or too few fields, go to a second
table with their file and raw line, all others to the first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.session import remove_path, scratch_path

HEADER_BYTES = 1 << 16  # a header line is at most so long
OPENED = 32  # headers read at once
#: Names of the rescued table's columns, also used while parsing.
RAW, FILE, RESCUED = "_raw", "_file", "_rescued"


@dataclass(frozen=True)
class HeaderGroup:
    """Files that start with the same header line."""

    columns: tuple[str, ...]
    files: tuple[str, ...]


@dataclass(frozen=True)
class CsvLoad:
    """What :func:`load_csv` made: good rows, bad records (file, raw line), the header groups, and the folder written."""

    rows: DataFrame
    rescued: DataFrame
    groups: tuple[HeaderGroup, ...]
    path: str

    def remove(self) -> None:
        remove_path(self.rows.sparkSession, self.path)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """Files that ``path`` (a folder, a file or a pattern) names, without hidden and empty ones."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    where = hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    found = [f for top in (fs.globStatus(where) or []) for f in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
    files = [f for f in found if f.isFile() and f.getLen() > 0 and not f.getPath().getName().startswith(("_", "."))]
    return sorted(f.getPath().toString() for f in files)


def _header_line(spark: SparkSession, file: str) -> bytes:
    """The first line of a file, unpacked if its name says that it is compressed."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    where = hadoop.fs.Path(file)
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        opened = codec.createInputStream(stream) if codec else stream
        start = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(
            spark._jvm.org.apache.commons.io.input.BoundedInputStream(opened, HEADER_BYTES)))
    finally:
        stream.close()
    line, end, _ = start.partition(b"\n")
    if not end and len(start) == HEADER_BYTES:
        raise ValueError(f"{file} has no header line within {HEADER_BYTES} bytes")
    return line.rstrip(b"\r")


def header_groups(spark: SparkSession, path: str, sep: str = ",") -> list[HeaderGroup]:
    """The files below ``path`` by header line; only the first bytes of each file are read."""
    files = _data_files(spark, path)
    with ThreadPoolExecutor(max_workers=OPENED) as pool:
        lines = list(pool.map(lambda f: _header_line(spark, f), files))
    by_line: dict[bytes, list[str]] = {}
    for file, line in zip(files, lines):
        by_line.setdefault(line, []).append(file)
    # Spark names a group's columns from one of its files, as it does when it reads them.
    return [HeaderGroup(tuple(spark.read.options(header=True, sep=sep).csv(own[0]).columns), tuple(own)) for own in by_line.values()]


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_mixed(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None, sep: str = ",") -> DataFrame:
    """As ``read_csv_typed``, for a folder whose files have different headers.

    Columns are those of all files; a file that lacks one gives NULL there. A
    value that its type cannot hold is NULL. A folder without data files has no
    columns to name, which is an error.
    """
    types = types or {}
    groups = header_groups(spark, path, sep)
    if not groups:
        raise ValueError(f"no CSV files at {path}")

    def read(group: HeaderGroup) -> DataFrame:
        raw = spark.read.schema(_strings(group.columns)).options(header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False).csv(list(group.files))
        return raw.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns])

    return _united([read(g) for g in groups])


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def load_csv(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None, sep: str = ",",
             announce: Callable[[str], None] | None = None) -> CsvLoad:
    """Headed CSV files to two Parquet tables in the shared folder, in one pass over the text.

    ``rows`` has the columns of all headers, typed by ``types`` (others are
    strings). ``rescued`` has ``_file`` and ``_raw`` of every record with a field
    that its type cannot hold or with another number of fields than its file's
    header; nothing of it is in ``rows``, and no record is lost. A field of a
    typed column must be the bare value: blanks around a number make the record
    a rescued one. ``announce`` is told the folder before it is written.
    """
    types = types or {}
    groups = header_groups(spark, path, sep)
    if not groups:
        raise ValueError(f"no CSV files at {path}")

    def parse(group: HeaderGroup) -> DataFrame:
        schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in group.columns]).add(RAW, T.StringType())
        return (
            spark.read.schema(schema)
            .options(header=True, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
            .csv(list(group.files))
            .select("*", F.when(F.col(RAW).isNotNull(), F.col("_metadata.file_path")).alias(FILE), F.col(RAW).isNotNull().alias(RESCUED))
        )

    parsed = _united([parse(g) for g in groups])
    folder = scratch_path(spark, "csv-load")
    if announce:
        announce(folder)
    parsed.write.partitionBy(RESCUED).parquet(folder)
    back = spark.read.schema(parsed.schema).parquet(folder)
    rows = back.where(~F.col(RESCUED)).drop(RAW, FILE, RESCUED)
    rescued = back.where(F.col(RESCUED)).select(FILE, RAW)
    return CsvLoad(rows, rescued, tuple(groups), folder)
