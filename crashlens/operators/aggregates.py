"""Aggregation operators that return DataFrames (never a driver-side number)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def global_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Row count as a one-row DataFrame ``(name: bigint)``.

    Unlike ``df.count()`` this is lazy: it is one plan the caller can
    collect, write or union, with partial counts per task and one tiny
    final merge.
    """
    return df.agg(F.count(F.lit(1)).alias(name))


def count_groups_having(df: DataFrame, keys: Sequence[str], measure: Column, predicate,
                        name: str = "n") -> DataFrame:
    """Number of groups whose aggregate passes ``predicate`` (SQL HAVING + COUNT).

    ``predicate`` receives the aggregate column. Aggregation is partial per
    task first (map-side combine), so a hot key costs one row per task in
    the shuffle, not all its rows.
    """
    grouped = df.groupBy(*keys).agg(measure.alias("_measure"))
    return global_count(grouped.filter(predicate(F.col("_measure"))), name)


def count_distinct_per(df: DataFrame, keys: Sequence[str], counted: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct ``counted`` tuples per ``keys``, as ``distinct`` + ``count``.

    Written as two aggregations instead of ``count_distinct`` on purpose:
    the distinct step is hashed on all of ``keys + counted``, so one hot key
    with many distinct values is spread over many tasks, and the following
    count combines map-side before its own, much smaller, shuffle.
    """
    return df.select(*keys, *counted).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
