"""Top-k values and membership in a top-k set."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(measure: str, keys: Sequence[str]) -> list[Column]:
    """Measure descending, then keys ascending: a total order, so ties are
    broken the same way in every run and in the SQL oracle."""
    return [F.col(measure).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]


def top_k(df: DataFrame, keys: str | Sequence[str], k: int, measure: Column | None = None,
          name: str = "n", keep_measure: bool = True) -> DataFrame:
    """The ``k`` most frequent (or highest-``measure``) groups of ``keys``.

    ``groupBy`` + ``orderBy`` + ``limit`` plans as a partial/final hash
    aggregate followed by ``TakeOrderedAndProject``: each task keeps only its
    own best ``k`` rows, so nothing but ``k`` rows per task reaches the final
    merge, whatever the number of groups.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    measure = F.count(F.lit(1)) if measure is None else measure
    out = df.groupBy(*keys).agg(measure.alias(name)).orderBy(*ordered(name, keys)).limit(k)
    return out if keep_measure else out.drop(name)


def in_top_k(df: DataFrame, column: str, top: DataFrame, top_column: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` is one of the values in ``top``.

    A ``left_semi`` join inside the same plan instead of collecting the set
    to the driver and pasting it in as literals. A set made by a limit
    carries its size, so Spark broadcasts it by its own threshold and
    shuffles a larger one. NULL never matches, just like ``isin``.
    """
    top_column = top_column or column
    right = top.select(F.col(top_column).alias("_member"))
    return df.join(right, F.col(column) == F.col("_member"), "left_semi")


def best_k(df: DataFrame, measure: str, keys: str | Sequence[str], k: int, keep_measure: bool = True) -> DataFrame:
    """The ``k`` rows of an already aggregated ``df`` with the highest ``measure``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.orderBy(*ordered(measure, keys)).limit(k)
    return out if keep_measure else out.drop(measure)
