"""Several grouped aggregates of one table from one pass over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tag:
    """One aggregate: rows that meet ``condition``, by ``keys``; their count and the sum of the column ``measure``."""

    name: str
    condition: Column
    keys: Sequence[str] = ()
    measure: str | None = None


def tagged_aggregates(df: DataFrame, tags: Sequence[Tag]) -> DataFrame:
    """``(tag, keys of all tags, n, total)``: the groups of every tag, from one scan and one shuffle.

    Equals a union of ``df.where(condition).groupBy(*keys).agg(count, sum(measure))``
    with NULL for the keys that a tag does not group by; a tag without keys
    has one group, or none without rows. A row becomes one narrow row for each
    tag whose condition it meets, and these combine map-side, so a hot key
    sends one row per task and tag. ``total`` is NULL where a tag has no
    measure, or only NULLs.
    """
    names = list(dict.fromkeys(k for tag in tags for k in tag.keys))
    types = {f.name: f.dataType for f in df.schema.fields}

    def row(tag: Tag) -> Column:
        keys = [(F.col(k) if k in tag.keys else F.lit(None).cast(types[k])).alias(k) for k in names]
        measure = F.col(tag.measure).cast("long") if tag.measure else F.lit(None).cast("long")
        return F.when(tag.condition, F.struct(F.lit(tag.name).alias("tag"), *keys, measure.alias("_m")))

    # Tags that a row does not meet are filtered after the explode: dropping them from the array takes an interpreted lambda.
    rows = df.select(F.explode(F.array(*[row(tag) for tag in tags])).alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")
    return rows.groupBy("tag", *names).agg(F.count(F.lit(1)).alias("n"), F.sum("_m").alias("total"))


def rows_of_tag(aggregated: DataFrame, tag: Tag) -> DataFrame:
    """``(keys, n, total)`` of one tag."""
    return aggregated.where(F.col("tag") == tag.name).select(*tag.keys, "n", "total")
