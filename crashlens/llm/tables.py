"""Tables written to the shared checkpoint folder, to cut lineage and to be read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crashlens.session import remove_path, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Lost executors cost nothing that was written; the plan starts at the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_path = path
    return back


def remove(*frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later step reads."""
    for df in frames:
        path = getattr(df, "_written_path", None)
        if path:
            remove_path(df.sparkSession, path)
            df._written_path = None
