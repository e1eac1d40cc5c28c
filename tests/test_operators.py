"""Generic operators against their direct Spark equivalents on native tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from crashlens.operators import (
    count_distinct_per,
    dense_rank_all,
    join_count,
    number_per_group,
    rank_band_wide,
)


def test_dense_rank_all_equals_window(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet").select("p_partkey", "p_retailprice")
    got = {(r.p_partkey, r.rnk) for r in dense_rank_all(spark, part, "p_retailprice", rank_name="rnk").collect()}
    w = Window.orderBy(F.col("p_retailprice").desc())
    want = {(r.p_partkey, r.rnk) for r in part.withColumn("rnk", F.dense_rank().over(w)).collect()}
    assert got == want


def test_dense_rank_all_ascending_with_nulls(spark):
    df = spark.createDataFrame([(1, 3), (2, None), (3, 1), (4, 3)], "id int, v int")
    got = sorted((r.id, r.rnk) for r in dense_rank_all(spark, df, "v", descending=False, partitions=3).collect())
    assert got == [(1, 2), (2, 3), (3, 1), (4, 2)]


def test_join_count_equals_join_then_count(spark, tables):
    keys = ["CRASH_ID", "UNIT_NBR"]
    got = {r.VEH_MAKE_ID: r.n for r in join_count(tables.units, tables.person, keys, ["VEH_MAKE_ID"]).collect()}
    people = tables.person.select(*keys)
    want = {r.VEH_MAKE_ID: r["count"] for r in tables.units.join(people, keys).groupBy("VEH_MAKE_ID").count().collect()}
    assert got == want


def test_join_count_total_and_empty(spark, tables):
    keys = ["CRASH_ID", "UNIT_NBR"]
    total = join_count(tables.units, tables.person, keys).collect()[0].n
    assert total == tables.units.join(tables.person.select(*keys), keys).count()
    empty = tables.person.filter(F.lit(False))
    assert join_count(tables.units, empty, keys).collect()[0].n == 0


def test_count_distinct_per(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    got = {r.l_suppkey: r.n for r in count_distinct_per(li, ["l_suppkey"], ["l_orderkey"]).collect()}
    want = {r.l_suppkey: r.n for r in li.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n")).collect()}
    assert got == want


def test_numbering_splits_a_group_that_holds_most_rows(spark):
    rows = [("hot", i * 7 % 1000) for i in range(1000)] + [(None, 3), (None, 1), ("b", 2)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = number_per_group(df, "g", [F.col("v").asc()], partitions=7).collect()
    assert len(got) == len(rows)
    assert sorted((r.v, r.rn) for r in got if r.g == "hot") == [(i, i + 1) for i in range(1000)]
    assert sorted((r.v, r.rn) for r in got if r.g is None) == [(1, 1), (3, 2)]
    assert [(r.v, r.rn) for r in got if r.g == "b"] == [(2, 1)]


def test_wide_band_equals_global_rank(spark):
    df = spark.createDataFrame([(i % 50 if i % 9 else None,) for i in range(300)], "v int")
    got = rank_band_wide(spark, df, "v", 10, 60).collect()
    ranks = {v: i + 1 for i, v in enumerate([*sorted({r.v for r in df.collect() if r.v is not None}, reverse=True), None])}
    assert all(ranks[r.v] == r.rnk for r in got)
    assert len(got) == sum(10 <= ranks[r.v] <= 60 for r in df.collect())
