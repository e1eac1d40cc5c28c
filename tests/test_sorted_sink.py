"""Ordered results in many files: every value back, files in order, bounds right, a hot key shared out."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.sources.sorted_sink import in_order, read_manifest, read_sorted, write_sorted

TYPES = {"k": T.IntegerType(), "v": T.StringType(), "i": T.LongType()}


def frame(spark, n=4000):
    # a third of the rows have key 7, some have none
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * 7919 % 1000).cast("int")).cast("int")
    value = F.when(F.col("id") % 11 == 0, 'a,"b"\nc').when(F.col("id") % 13 == 0, None).otherwise(F.concat(F.lit("v"), F.col("id") % 100))
    return spark.range(n).select(key.alias("k"), value.alias("v"), F.col("id").alias("i")).repartition(6)


def order(k):
    return (k is not None, k if k is not None else 0)


@pytest.mark.parametrize("descending", [False, True])
def test_files_follow_each_other(spark, tmp_out, descending):
    df = frame(spark)
    manifest = write_sorted(df, tmp_out, ["k", "i"], descending=descending, files=9)
    assert in_order(manifest, descending)
    back = read_sorted(spark, tmp_out, TYPES).collect()
    assert sorted((str(r.k), str(r.v), r.i) for r in back) == sorted((str(r.k), str(r.v), r.i) for r in df.collect())
    by_file = {}
    for r in back:
        by_file.setdefault(r._file, []).append((*order(r.k), r.i))
    assert len(by_file) == 9
    in_sequence = [k for name in sorted(by_file) for k in by_file[name]]  # rows of a file come in its order
    assert in_sequence == sorted(in_sequence, reverse=descending)
    for r in read_manifest(spark, tmp_out).collect():
        own = by_file[r.file]
        assert r.n == len(own) and (*order(r["first"].k), r["first"].i) == own[0] and (*order(r["last"].k), r["last"].i) == own[-1]


def test_a_hot_key_does_not_make_one_large_file(spark, tmp_out):
    manifest = write_sorted(frame(spark), tmp_out, ["k"], files=12).collect()
    assert max(r.n for r in manifest) < 3 * 4000 / 12 and sum(r.n for r in manifest) == 4000
    assert sum(r["first"].k == 7 and r["last"].k == 7 for r in manifest) >= 2  # one key over several files


def test_no_single_task_sorts_or_writes(spark, tmp_out):
    write_sorted(frame(spark), tmp_out, ["k"], files=5)
    assert len(set(r._file for r in read_sorted(spark, tmp_out, TYPES).select("_file").distinct().collect())) == 5


def test_out_of_order_bounds_are_seen(spark):
    rows = [("part-0", 2, (1,), (5,)), ("part-1", 2, (4,), (9,))]
    manifest = spark.createDataFrame(rows, "file string, n long, first struct<k:int>, last struct<k:int>")
    assert not in_order(manifest)
    assert in_order(manifest.where("file = 'part-0'")) and not in_order(manifest.where("file = 'part-0'"), descending=True)


def test_empty_and_replaced(spark, tmp_out):
    write_sorted(frame(spark), tmp_out, ["k"], files=4)
    manifest = write_sorted(frame(spark, 0), tmp_out, ["k"], files=4)
    assert manifest.count() == 0 and in_order(manifest)
