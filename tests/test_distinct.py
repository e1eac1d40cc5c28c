"""Distinct rows by fingerprints: equal to the direct form, exact under forced collisions, less than half the shuffle."""

import datetime
import decimal
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crashlens.operators import distinct_projection
from crashlens.operators.distinct import Matched, distinct_rows, row_fingerprint
from crashlens.plans import analyses as A
from crashlens.plans import variants as V
from crashlens.sources.catalog import CrashTables


def bag(df):
    return Counter(map(str, df.collect()))


ROWS = [
    (1, "a", None, 0.0, None), (1, None, "a", -0.0, None), (1, "a", None, -0.0, None), (1, "a", None, 0.0, None),
    (2, "", None, float("nan"), True), (2, None, "", float("nan"), True), (2, "", None, float("nan"), True),
    (None, None, None, None, None), (None, None, None, None, None), (3, "ab", "c", 1.5, False), (3, "a", "bc", 1.5, False),
] + [(4, f"x{i}", None, float(i % 7), None) for i in range(60)] * 2


@pytest.fixture
def odd_rows(spark):
    return spark.createDataFrame(ROWS, "k int, a string, b string, `d.e` double, f boolean").repartition(5)


def one_mark(values):
    return F.lit(1).cast("long"), F.lit(2).cast("long")


def few_marks(values):
    return F.pmod(F.xxhash64(*values), F.lit(5)), F.lit(0).cast("long")


@pytest.mark.parametrize("fingerprint", [None, one_mark, few_marks])
@pytest.mark.parametrize("keep", [["k"], ["k", "a"], ["a", "b"]])
def test_equals_the_direct_form_even_if_fingerprints_collide(odd_rows, fingerprint, keep):
    how = {"fingerprint": fingerprint} if fingerprint else {}
    assert bag(distinct_projection(odd_rows, keep, **how)) == bag(odd_rows.distinct().select(*keep))
    named = [F.col("k"), F.coalesce("a", F.lit("?")).alias("a2")]
    assert bag(distinct_projection(odd_rows, named, **how)) == bag(odd_rows.distinct().select(*named))


def test_other_types_and_nested_columns(spark):
    day, time, price = datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1, 5), decimal.Decimal("1.50")
    df = spark.createDataFrame([(day, time, price, b"x", 1), (day, time, price, b"x", 1), (day, time, price, b"y", 1)],
                               "d date, t timestamp, p decimal(10,2), b binary, n byte")
    assert distinct_projection(df, ["d", "p"]).count() == 2
    nested = df.withColumn("arr", F.array("n")).withColumn("m", F.lit(1))
    assert bag(distinct_projection(nested, ["m"])) == bag(nested.distinct().select("m"))
    assert distinct_projection(df.limit(0), ["d"]).collect() == []


def shuffled(spark, df):
    """Bytes written to shuffles by running ``df``."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def wide(df):
    return df.select("*", *[F.concat_ws("-", F.lit(f"extra {i}"), F.xxhash64("CRASH_ID", "UNIT_NBR", F.lit(i))).alias(f"X{i}") for i in range(40)])


@pytest.mark.parametrize("name", ["a07_ethnicity_per_body", "a08_zips_alcohol", "a10_speeding_makes_top_colour_state"])
def test_wide_rows_shuffle_less_than_half(spark, tables, name):
    t = CrashTables(person=wide(tables.person), units=wide(tables.units), damages=tables.damages)
    analysis = getattr(A, name)
    late = analysis(t)
    rows, bytes_late = bag(late), shuffled(spark, analysis(t))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(A, "distinct_projection", lambda df, keep: df.distinct().select(*keep))
        direct = analysis(t)
        assert bag(direct) == rows
        bytes_direct = shuffled(spark, analysis(t))
    assert 0 < bytes_late < bytes_direct / 2


def test_the_second_branch_is_not_run(tables):
    late = distinct_projection(tables.units, ["VEH_BODY_STYL_ID"])
    late.collect()
    final = late._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and final.count("Scan parquet") >= 1
    first = final.split("== Initial Plan ==")[0]
    assert "LeftSemi" not in first  # no doubted fingerprint, so nothing is read again


@pytest.mark.parametrize("bits", [1, 64, 1 << 20])
def test_distinct_rows_equal_distinct_however_many_bits_are_set(odd_rows, bits):
    assert bag(distinct_rows(odd_rows, bits)) == bag(odd_rows.distinct())
    nested = odd_rows.select("k", F.array("a").alias("n"))
    assert bag(distinct_rows(nested)) == bag(nested.distinct())


def test_only_rows_that_may_have_copies_are_shuffled_whole(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("row"), *[F.sha2(F.concat_ws("-", F.lit(i), "id"), 256).alias(f"c{i}") for i in range(4)])
    wide, whole = shuffled(spark, distinct_rows(rows)), shuffled(spark, rows.distinct())
    assert wide < 0.2 * whole


@pytest.mark.parametrize("keep", [["k"], ["k", "a"]])
def test_a_projection_of_matched_rows_is_that_of_a_semi_join(spark, odd_rows, keep):
    other = spark.createDataFrame([(2, "x"), (4, "x"), (4, "y"), (None, "x")], "k int, v string")
    for fingerprint in (row_fingerprint, few_marks):
        got = distinct_projection(Matched(odd_rows, other, ["k"]), keep, fingerprint)
        assert bag(got) == bag(odd_rows.join(other, "k", "left_semi").distinct().select(*keep))
    with pytest.raises(ValueError, match="not all kept"):
        distinct_projection(Matched(odd_rows, other, ["k"]), ["a"])


def test_injury_totals_shuffle_narrow_rows(spark, tables):
    t = CrashTables(person=tables.person, units=wide(tables.units), damages=tables.damages)
    direct = CrashTables(person=tables.person, units=t.units, damages=tables.damages, units_rows=t.units.distinct())
    assert bag(V.a06i_makes_injury_total_rank_3_5(t)) == bag(V.a06i_makes_injury_total_rank_3_5(direct))
    assert shuffled(spark, V.a06i_makes_injury_total_rank_3_5(t)) < shuffled(spark, V.a06i_makes_injury_total_rank_3_5(direct)) / 4


def test_a_row_is_shuffled_with_one_fingerprint(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.xxhash64("id").alias("v"))
    assert shuffled(spark, distinct_projection(rows, ["k"])) < 20_000 * 28  # 24 bytes of hashes, 32 with one more
