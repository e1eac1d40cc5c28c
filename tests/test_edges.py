"""Edge cases on tiny hand-made frames: NULL logic, numbers in text, ranks, ties, clashes."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.functions import first_int, not_in
from crashlens.operators import in_top_k, join_renaming, rank_band, top_k, top_per_group
from crashlens.plans import analyses as A
from crashlens.plans import variants as V
from crashlens.sources.catalog import CrashTables


def test_null_is_dropped_by_ne_and_not_in(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "v string")
    assert [r.v for r in df.filter(F.col("v") != "A").collect()] == ["B"]
    assert [r.v for r in df.filter(not_in("v", ["A"])).collect()] == ["B"]


def test_first_int(spark):
    df = spark.createDataFrame([("DAMAGED 7 HIGHEST",), ("NO DAMAGE",), (None,), ("X 99999999999",)], "v string")
    assert [r.n for r in df.select(first_int("v").alias("n")).collect()] == [7, 0, None, None]


def test_null_rank_is_last(spark):
    df = spark.createDataFrame([(5,), (4,), (None,)], "v int")
    got = sorted(rank_band(df, "v", 1, 3, rank_name="r").collect(), key=lambda r: r.r)
    assert [(r.v, r.r) for r in got] == [(5, 1), (4, 2), (None, 3)]


def test_rank_band_keeps_ties(spark):
    df = spark.createDataFrame([(1, 9), (2, 9), (3, 8), (4, 7), (5, 7), (6, 6)], "id int, v int")
    got = sorted((r.id, r.r) for r in rank_band(df, "v", 2, 3, rank_name="r").collect())
    assert got == [(3, 2), (4, 3), (5, 3)]


def test_empty_top_k_set_keeps_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    empty = df.filter(F.lit(False))
    assert in_top_k(df, "v", top_k(empty, "v", 3)).count() == 0


def test_top_k_ties_broken_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in top_k(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_top_per_group_tie(spark):
    df = spark.createDataFrame([("g", "y", 2), ("g", "x", 2), ("h", "z", 1)], "g string, e string, n long")
    got = top_per_group(df, "g", [F.col("n").desc(), F.col("e").asc()]).collect()
    assert sorted((r.g, r.e) for r in got) == [("g", "x"), ("h", "z")]


def test_name_clash_keeps_both(spark):
    u = spark.createDataFrame([(1, 1, 2)], "CRASH_ID long, UNIT_NBR int, DEATH_CNT int")
    p = spark.createDataFrame([(1, 1, 5)], "CRASH_ID long, UNIT_NBR int, DEATH_CNT int")
    row = join_renaming(u, p, ["CRASH_ID", "UNIT_NBR"], "_U", "_P").collect()[0]
    assert (row.DEATH_CNT_U, row.DEATH_CNT_P) == (2, 5)


def _tables(spark, units_rows=(), person_rows=(), damages_rows=()):
    units_schema = T.StructType([T.StructField(c, T.LongType() if c == "CRASH_ID" else
                                               T.IntegerType() if c in ("UNIT_NBR", "DEATH_CNT", "TOT_INJRY_CNT")
                                               else T.StringType())
                                 for c in ["CRASH_ID", "UNIT_NBR", "VEH_BODY_STYL_ID", "VEH_MAKE_ID", "VEH_COLOR_ID",
                                           "VEH_LIC_STATE_ID", "VEH_HNR_FL", "CONTRIB_FACTR_1_ID", "CONTRIB_FACTR_2_ID",
                                           "CONTRIB_FACTR_P1_ID", "VEH_DMAG_SCL_1_ID", "VEH_DMAG_SCL_2_ID",
                                           "FIN_RESP_TYPE_ID", "DEATH_CNT", "TOT_INJRY_CNT"]])
    person_schema = "CRASH_ID long, UNIT_NBR int, PRSN_TYPE_ID string, PRSN_GNDR_ID string, DEATH_CNT int"
    damages_schema = "CRASH_ID long, DAMAGED_PROPERTY string"
    return CrashTables(
        person=spark.createDataFrame(list(person_rows), person_schema),
        units=spark.createDataFrame(list(units_rows), units_schema),
        damages=spark.createDataFrame(list(damages_rows), damages_schema),
    )


def test_two_damage_rows_count_twice_in_a09_once_in_a09i(spark):
    unit = (1, 1, "PICKUP", "FORD", "C1", "S1", "N", None, None, None, "DAMAGED 7", "NA",
            "PROOF OF LIABILITY INSURANCE", 0, 1)
    t = _tables(spark, units_rows=[unit], damages_rows=[(1, "NONE"), (1, "NONE1"), (1, "NONE")])
    assert A.a09_no_damage_high_severity(t).collect()[0].n == 2
    assert V.a09i_no_damage_high_severity_crashes(t).collect()[0].n == 1


def test_empty_tables_give_zero_counts(spark):
    t = _tables(spark)
    assert A.a02_two_wheelers(t).collect()[0].n == 0
    assert A.a09_no_damage_high_severity(t).collect()[0].n == 0
    assert A.a01_crashes_male_deaths(t).collect()[0].n == 0
