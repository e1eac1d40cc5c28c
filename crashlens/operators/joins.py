"""Join operators.

The crash analyses join vehicles to people on ``(CRASH_ID, UNIT_NBR)``
and then only *count* the joined rows per some attribute. Materialising
the join is both wasteful (fan-out) and fragile under skew (one crash key
holding a large share of rows lands in one task). ``join_count`` instead
collapses each side to one row per ``(key, attribute)`` with a count, using
partial aggregation before the shuffle, and multiplies the counts after the
join: the same numbers, with at most a handful of rows per key left to join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def having_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with at least one partner in ``other`` (``left_semi``).

    The partner side is reduced to distinct keys first, a map-side combine
    that shrinks its shuffle when it repeats keys.
    """
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def lacking_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no partner in ``other`` (``left_anti``)."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def join_count(left: DataFrame, right: DataFrame, keys: Sequence[str], by_left: Sequence[str] = (),
               by_right: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows of ``left JOIN right USING (keys)`` counted per ``by_left + by_right``.

    Equals ``left.join(right, keys).groupBy(*by_left, *by_right).count()``
    but never builds the joined rows: each side becomes
    ``(keys, by_*, count)`` first, and ``count(join) = sum(nl * nr)``.
    """
    keys, by_left, by_right = list(keys), list(by_left), list(by_right)
    lc = left.groupBy(*keys, *by_left).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(*keys, *by_right).agg(F.count(F.lit(1)).alias("_nr"))
    product = F.col("_nl") * F.col("_nr")
    if not by_left and not by_right:
        # Both sides come out of aggregations hash-partitioned on exactly the
        # join keys: a merge join needs no exchange (and spills if it must).
        joined = lc.join(rc.hint("merge"), keys, "inner")
        return joined.agg(F.coalesce(F.sum(product), F.lit(0)).cast("bigint").alias(name))
    joined = lc.join(rc, keys, "inner")
    return joined.groupBy(*by_left, *by_right).agg(F.sum(product).cast("bigint").alias(name))


def counted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], n_left: str, n_right: str, name: str = "n") -> DataFrame:
    """As :func:`join_count` without attributes, for sides that are already counted: one row per key, its rows in ``n_left``, ``n_right``."""
    lc = left.select(*keys, F.col(n_left).alias("_nl"))
    joined = lc.join(right.select(*keys, F.col(n_right).alias("_nr")), list(keys), "inner")
    return joined.agg(F.coalesce(F.sum(F.col("_nl") * F.col("_nr")), F.lit(0)).cast("bigint").alias(name))


def join_renaming(left: DataFrame, right: DataFrame, keys: Sequence[str], left_suffix: str = "_L",
                  right_suffix: str = "_R", how: str = "inner") -> DataFrame:
    """Join on ``keys`` keeping same-named non-key columns under two names.

    ``DEATH_CNT`` exists in both crash tables; after a plain join an
    unqualified reference to it is ambiguous. Renaming before the join keeps
    both and makes every later reference unambiguous.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lr = left.select(*[F.col(c).alias(c + left_suffix) if c in clash else F.col(c) for c in left.columns])
    rr = right.select(*[F.col(c).alias(c + right_suffix) if c in clash else F.col(c) for c in right.columns])
    return lr.join(rr, keys, how)
