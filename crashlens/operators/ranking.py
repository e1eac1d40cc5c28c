"""Ranking operators: best row per group, rank bands, whole-table dense rank.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task. None of the operators here does that with unbounded input:

* ``top_per_group`` partitions by the group (and Catalyst adds a
  ``WindowGroupLimit`` so each task keeps only ``n`` rows per group early).
* ``rank_band`` ranks only the ``hi`` best *distinct values* (a bounded set,
  for a small constant band), then keeps the matching rows by a null-safe
  join (the band's values are distinct, so each row matches at most once).
  ``rank_band_wide`` takes any band, by the ranks of ``dense_rank_all``.
* ``dense_rank_all`` numbers all distinct values with range partitioning and
  per-partition offsets, the distributed ``zipWithIndex`` pattern;
  ``number_per_group`` numbers the rows of groups likewise, so a group that
  holds most rows is shared out.

The last two fix their range partitions by a checkpoint in the shared folder,
an action when they are called; its files go with the DataFrame if
``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlens.session import checkpoint_dir


def _order(value: str, descending: bool) -> Column:
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()


def top_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int = 1,
                  rank_name: str | None = None) -> DataFrame:
    """Rows with ``row_number() <= n`` per group (``rank_name`` keeps the number)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    col = rank_name or "_rn"
    out = df.withColumn(col, F.row_number().over(w)).filter(F.col(col) <= n)
    return out if rank_name else out.drop(col)


def number_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column],
                     rank_name: str = "rn", partitions: int | None = None) -> DataFrame:
    """``row_number()`` per group, all rows kept, however many of them one group has.

    Rows are range-partitioned on (group, order) and sorted, so a large group
    lies in several consecutive partitions. A row's number is its number
    within its partition and group, plus the rows of the group in earlier
    partitions; only a partition's first group can have such rows, so there
    is at most one offset per partition.
    """
    group = [group] if isinstance(group, str) else list(group)
    spark = df.sparkSession
    checkpoint_dir(spark)  # reliable checkpoints need the shared folder
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    placed = (
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    key = F.struct(*group)
    per_part = placed.groupBy("_pid", key.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_offset", F.sum("_n").over(earlier)).filter(F.col("_offset") > 0)  # at most a row per partition
    offsets = F.broadcast(offsets.select(F.col("_pid").alias("_at"), "_group", "_offset"))
    within = F.row_number().over(Window.partitionBy("_pid", *group).orderBy("_mid"))
    joined = placed.withColumn("_within", within).join(
        offsets, (F.col("_pid") == F.col("_at")) & key.eqNullSafe(F.col("_group")), "left")
    number = F.col("_within") + F.coalesce("_offset", F.lit(0))
    return joined.withColumn(rank_name, number.cast("int")).select(*df.columns, rank_name)


def top_values_ranked(df: DataFrame, value: str, hi: int, descending: bool = True,
                      rank_name: str = "rnk") -> DataFrame:
    """The ``hi`` best distinct values of ``value`` with their dense rank.

    ``distinct`` + ``orderBy`` + ``limit`` keeps at most ``hi`` rows per task
    and ``hi`` rows in the end; the window then runs on those ``hi`` rows
    only. NULL sorts last either way, as Spark's default ``desc`` does.
    """
    top = df.select(value).distinct().orderBy(_order(value, descending)).limit(hi)
    return top.withColumn(rank_name, F.dense_rank().over(Window.orderBy(_order(value, descending))))


def rank_band(df: DataFrame, value: str, lo: int, hi: int, descending: bool = True,
              rank_name: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``value`` has a dense rank in ``[lo, hi]``.

    Same rows (as a bag) as ``dense_rank().over(Window.orderBy(value))``
    filtered to the band, without the single-task window over them. The
    ``hi`` best values pass through one task: use it for small constant
    bands. A limit carries its size, so Spark chooses the join by it; the
    join is null-safe because a NULL value can hold a rank too.
    """
    band = top_values_ranked(df, value, hi, descending, "_rnk").filter(F.col("_rnk").between(lo, hi))
    band = band.select(F.col(value).alias("_band_value"), "_rnk")
    matched = df.join(band, F.col(value).eqNullSafe(F.col("_band_value")), "inner").drop("_band_value")
    return matched.withColumnRenamed("_rnk", rank_name) if rank_name else matched.drop("_rnk")


def rank_band_wide(spark: SparkSession, df: DataFrame, value: str, lo: int, hi: int, descending: bool = True,
                   rank_name: str = "rnk") -> DataFrame:
    """As :func:`rank_band`, for a band of any width: all values are ranked by :func:`dense_rank_all`."""
    return dense_rank_all(spark, df, value, descending, rank_name).filter(F.col(rank_name).between(lo, hi))


def dense_rank_all(spark: SparkSession, df: DataFrame, value: str, descending: bool = True,
                   rank_name: str = "rnk", partitions: int | None = None) -> DataFrame:
    """``dense_rank()`` of ``value`` over the whole table, distributed.

    1. distinct values, range-partitioned in rank order and sorted in each
       partition; ``monotonically_increasing_id`` then numbers rows in that
       order (partition id in the upper bits, position in the lower bits);
    2. the numbered values are checkpointed to the shared folder, so range
       bounds and ids are fixed once and a lost executor re-reads them;
    3. per-partition counts (one row per partition) give each partition its
       offset; rank = offset + position + 1;
    4. the ranks join back to the rows on the (null-safe) value.
    """
    checkpoint_dir(spark)  # reliable checkpoints need the shared folder
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _order(value, descending)
    numbered = (
        df.select(value).distinct()
        .repartitionByRange(parts, order)
        .sortWithinPartitions(order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    local = numbered.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.withColumn(
        "_offset",
        F.coalesce(F.sum("_size").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    ranks = local.join(F.broadcast(offsets.select("_pid", "_offset")), "_pid").select(
        F.col(value).alias("_rank_value"), (F.col("_offset") + F.col("_pos") + 1).cast("int").alias(rank_name)
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_rank_value")), "inner").drop("_rank_value")
