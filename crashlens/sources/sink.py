"""CSV sink for analysis results, and its reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for NULL in written files, so that NULL, the empty string and a
#: one-column row without a value stay apart. A value that is exactly this
#: text is read back as NULL.
NULL_TOKEN = "\\N"

_OPTIONS = {
    "header": True, "nullValue": NULL_TOKEN, "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, files: int | None = 1, mode: str = "overwrite") -> int:
    """Write ``df`` as headed CSV; returns the number of rows written.

    Commas, quotes, line breaks, blanks, empty strings and NULL all come back
    from :func:`read_result` as they were. ``files=1`` gives the single part
    file the reports are read as; use it only for bounded results (top-k
    lists, per-style winners). It is done by a ``repartition`` rather than
    ``coalesce`` so the upstream stage keeps its parallelism. ``files=None``
    keeps the plan's own partitioning, for results whose size grows with the
    input. The rows are counted by the write itself, not by a second read.
    """
    written = Observation()
    out = (df.repartition(files) if files else df).observe(written, F.count(F.lit(1)).alias("rows"))
    out.write.mode(mode).options(**_OPTIONS).csv(path)
    return written.get["rows"]


def read_result(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Read what :func:`write_csv` wrote; named columns cast to ``types``, the rest strings.

    A value may hold line breaks, so a file is read by one task: for results,
    not for large inputs.
    """
    raw = spark.read.options(**_OPTIONS, multiLine=True, enforceSchema=False).csv(path)
    return raw.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in (types or {}) else F.col(f"`{c}`") for c in raw.columns])
