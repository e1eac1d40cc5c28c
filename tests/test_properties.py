"""Property tests: operators against a plain-Python specification.

Small random tables with NULL keys and values, exact duplicates and hot
keys; each operator's Spark result must equal the direct definition.
"""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crashlens.operators import count_groups_having, join_count, lacking_match, rank_band, top_k

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 3))
values = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
rows = st.lists(st.tuples(keys, values), max_size=25)


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string")


@SETTINGS
@given(left=rows, right=rows)
def test_join_count_is_the_join_size_per_attribute(spark, left, right):
    got = {(r.v, r.w): r.n for r in join_count(
        frame(spark, left), frame(spark, right).withColumnRenamed("v", "w"), ["k"], ["v"], ["w"]).collect()}
    want = Counter((lv, rv) for lk, lv in left for rk, rv in right if lk is not None and lk == rk)
    assert got == dict(want)


@SETTINGS
@given(data=st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=25), lo=st.integers(1, 3),
       width=st.integers(0, 2))
def test_rank_band_matches_dense_rank(spark, data, lo, width):
    hi = lo + width
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v int")
    got = sorted((r.id, r.r) for r in rank_band(df, "v", lo, hi, rank_name="r").collect())
    order = sorted({v for v in data if v is not None}, reverse=True) + ([None] if None in data else [])
    rank = {v: i + 1 for i, v in enumerate(order)}
    want = sorted((i, rank[v]) for i, v in enumerate(data) if lo <= rank[v] <= hi)
    assert got == want


@SETTINGS
@given(data=rows, k=st.integers(1, 4))
def test_top_k_counts_and_tie_order(spark, data, k):
    got = [tuple(r) for r in top_k(frame(spark, data), "v", k).collect()]
    counts = Counter(v for _, v in data)
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[:k]
    assert got == want


@SETTINGS
@given(data=rows)
def test_count_groups_having_counts_null_group_too(spark, data):
    df = frame(spark, data).withColumn("x", F.lit(1))
    got = count_groups_having(df, ["k"], F.sum("x"), lambda s: s > 1).collect()[0].n
    want = sum(1 for c in Counter(k for k, _ in data).values() if c > 1)
    assert got == want


@SETTINGS
@given(left=rows, right=rows)
def test_lacking_match_is_not_exists(spark, left, right):
    got = Counter(tuple(r) for r in lacking_match(frame(spark, left), frame(spark, right), ["k"]).collect())
    right_keys = {k for k, _ in right if k is not None}
    want = Counter((k, v) for k, v in left if k is None or k not in right_keys)
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.one_of(st.none(), st.integers(-5, 30)), min_size=1, max_size=30), desc=st.booleans(),
       parts=st.integers(1, 4))
def test_dense_rank_all_matches_definition(spark, data, desc, parts):
    from crashlens.operators import dense_rank_all

    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v int")
    got = sorted((r.id, r.r) for r in dense_rank_all(spark, df, "v", desc, "r", partitions=parts).collect())
    order = sorted({v for v in data if v is not None}, reverse=desc) + ([None] if None in data else [])
    rank = {v: i + 1 for i, v in enumerate(order)}
    assert got == sorted((i, rank[v]) for i, v in enumerate(data))


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["g", "h"]), st.sampled_from(["x", "y", "z"]), st.integers(0, 3)),
                     max_size=20))
def test_top_per_group_keeps_best_with_tie_break(spark, data):
    from crashlens.operators import top_per_group

    df = spark.createDataFrame(data, "g string, e string, n int")
    got = sorted(tuple(r) for r in top_per_group(df, "g", [F.col("n").desc(), F.col("e").asc()]).collect())
    best = {}
    for g, e, n in data:
        if g not in best or (-n, e) < (-best[g][1], best[g][0]):
            best[g] = (e, n)
    assert got == sorted((g, e, n) for g, (e, n) in best.items())


@SETTINGS
@given(left=rows, right=rows)
def test_having_match_is_exists(spark, left, right):
    from crashlens.operators import having_match

    got = Counter(tuple(r) for r in having_match(frame(spark, left), frame(spark, right), ["k"]).collect())
    right_keys = {k for k, _ in right if k is not None}
    assert got == Counter((k, v) for k, v in left if k is not None and k in right_keys)


@SETTINGS
@given(data=rows)
def test_count_distinct_per_counts_distinct_tuples(spark, data):
    from crashlens.operators import count_distinct_per

    got = {r.k: r.n for r in count_distinct_per(frame(spark, data), ["k"], ["v"]).collect()}
    want = Counter(k for k, _ in set(data))
    assert got == dict(want)
