"""One pass per table for six analyses: the same answers, on empty and skewed tables too, and fewer scans."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crashlens.operators import Tag, rows_of_tag, tagged_aggregates
from crashlens.plans import analyses as A
from crashlens.plans import report, shared_scan
from crashlens.plans.report import run_report
from crashlens.plans.shared_scan import SHARED, share
from crashlens.sources.catalog import CrashTables, stage, unstage


def bag(df):
    return Counter(map(str, df.collect()))


def variants(t):
    """Tables as they are, empty, with NULL keys and measures, and with most rows on one crash."""
    some = F.col("CRASH_ID") % 3 != 0
    bare = {n: df.withColumn("DEATH_CNT", F.when(some, F.col("DEATH_CNT"))) for n, df in t.as_dict().items() if n != "damages"}
    bare = {n: df.withColumn("UNIT_NBR", F.when(F.col("CRASH_ID") % 5 != 0, F.col("UNIT_NBR"))) for n, df in bare.items()}
    hot = {n: df.withColumn("CRASH_ID", F.when(F.col("CRASH_ID") % 10 < 7, 1).otherwise(F.col("CRASH_ID")).cast("long")) for n, df in t.as_dict().items()}
    return {
        "given": t, "empty": CrashTables(**{n: df.limit(0) for n, df in t.as_dict().items()}),
        "nulls": CrashTables(**bare, damages=t.damages), "hot": CrashTables(**hot),
    }


@pytest.mark.parametrize("kind", ["given", "empty", "nulls", "hot"])
def test_the_same_answers(spark, tables, kind):
    t = variants(tables)[kind]
    shared = share(spark, t)
    for name in sorted(SHARED):
        fn = getattr(A, name)
        assert bag(fn(shared)) == bag(fn(t)), name
    for name in ("a03_top_makes_no_airbag", "a05_state_non_female"):
        fn = getattr(A, name)
        assert bag(fn(shared, k=50, with_counts=True)) == bag(fn(t, k=50, with_counts=True)), name
    unstage(spark, shared)



def test_each_table_is_scanned_once(spark, tables):
    staged = stage(spark, tables)
    person, units, _ = staged.staged_paths
    scans = Counter()

    def count(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for name, columns in (("person", "PRSN_GNDR_ID"), ("units", "VEH_HNR_FL")):
            scans[name] += sum("Relation" in line and columns in line for line in plan.splitlines())

    for name in SHARED:
        count(getattr(A, name)(staged))
    assert scans["person"] >= 4 and scans["units"] >= 4
    scans.clear()
    shared = share(spark, staged)
    for name in SHARED:
        df = getattr(A, name)(shared)
        count(df)
        assert not [f for f in df.inputFiles() if any(p.removeprefix("file:") in f for p in (person, units))]
    assert not +scans
    for table, tags in (("person", A.person_tags()), ("units", A.units_tags())):
        count(tagged_aggregates(staged.as_dict()[table], list(tags.values())))
    assert scans == {"person": 1, "units": 1}
    # An analysis reads the folder of its tag only.
    files = A.a02_two_wheelers(shared)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in files and "= a02)" in files
    unstage(spark, shared)


def test_the_report_shares_scans_and_cleans_up(spark, tables, tmp_out, monkeypatch):
    made = []
    monkeypatch.setattr(shared_scan, "scratch_path", lambda s, name, real=shared_scan.scratch_path: made.append(real(s, name)) or made[-1])
    status = {r.analysis: r for r in run_report(spark, tables, tmp_out).collect()}
    assert len(made) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in made)
    assert all(r.status == "success" for r in status.values()) and status["a04_hit_and_run_licensed"].n == 1853


def test_a_shared_scan_that_fails_leaves_the_others_alone(spark, tables, tmp_out):
    broken = CrashTables(person=tables.person, units=tables.units.drop("VEH_HNR_FL"), damages=tables.damages)
    status = {r.analysis: r for r in run_report(spark, broken, tmp_out, retries=0).collect()}
    assert {n for n, r in status.items() if r.status == "error"} == {"a04_hit_and_run_licensed"}
    assert "VEH_HNR_FL" in status["a04_hit_and_run_licensed"].error


def test_nothing_is_shared_if_nothing_needs_it(spark, tables, tmp_out, monkeypatch):
    run_report(spark, tables, tmp_out, run_id="v1")
    monkeypatch.setattr(report, "share", lambda *a, **k: pytest.fail("shared without need"))
    run_report(spark, tables, tmp_out, run_id="v1")


def test_tags_without_keys_rows_or_measures(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, None, "y"), (2, None, None)], "k int, v int, s string")
    tags = [Tag("all", F.lit(True)), Tag("none", F.col("k") > 9, ["k"], "v"), Tag("by_k", F.col("s").isNotNull(), ["k"], "v"),
            Tag("by_s", F.col("s") != "x", ["s"], "v"), Tag("both", F.lit(True), ["s", "k"])]
    out = tagged_aggregates(df, tags)
    assert out.columns == ["tag", "k", "s", "n", "total"]
    got = {tag.name: sorted(map(tuple, rows_of_tag(out, tag).collect()), key=str) for tag in tags}
    assert got == {"all": [(3, None)], "none": [], "by_k": [(1, 2, 5)], "by_s": [("y", 1, None)],
                   "both": [("x", 1, 1, None), ("y", 1, 1, None), (None, 2, 1, None)]}


def test_tags_run_no_interpreted_lambda(tables):
    plan = tagged_aggregates(tables.units, list(A.units_tags().values()))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
