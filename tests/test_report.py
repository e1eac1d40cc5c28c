"""Report job: all ten analyses, table results written, errors become rows."""

import os
from collections import Counter

from pyspark.sql import functions as F

from crashlens.plans.report import all_counts, run_report
from crashlens.plans import analyses as A
from crashlens.session import scratch_path
from crashlens.sources import catalog
from crashlens.sources.catalog import CrashTables
from crashlens.sources.sink import read_result


def test_all_counts(tables):
    got = {r.analysis: r.n for r in all_counts(tables).collect()}
    assert got == {"a01_crashes_male_deaths": 7, "a02_two_wheelers": 384,
                   "a04_hit_and_run_licensed": 1853, "a09_no_damage_high_severity": 384}


def test_run_report_writes_tables_and_reports_status(spark, tables, tmp_out):
    status = {r.analysis: r for r in run_report(spark, tables, tmp_out).collect()}
    assert len(status) == 10
    assert all(r.status == "success" for r in status.values()), [r.error for r in status.values()]
    assert status["a02_two_wheelers"].n == 384
    rows = lambda name: [r[0] for r in read_result(spark, status[name].path).collect()]
    assert rows("a05_state_non_female") == ["Texas"]
    assert sorted(rows("a03_top_makes_no_airbag")) == sorted(["FORD", "CHEVROLET", "TOYOTA", "DODGE", "MAZDA"])
    assert os.path.isdir(status["a07_ethnicity_per_body"].path)
    assert status["a07_ethnicity_per_body"].n == 6


def test_one_failure_does_not_stop_the_rest(spark, tables, tmp_out):
    broken = CrashTables(person=tables.person, units=tables.units.drop("VEH_MAKE_ID"), damages=tables.damages)
    status = {r.analysis: r for r in run_report(spark, broken, tmp_out, stage_tables=False, stage_distinct=False,
                                                  retries=0).collect()}
    assert status["a03_top_makes_no_airbag"].status == "error"
    assert "VEH_MAKE_ID" in status["a03_top_makes_no_airbag"].error
    assert status["a02_two_wheelers"].status == "success"
    assert status["a01_crashes_male_deaths"].n == 7


def test_cli_end_to_end_from_csv(spark, tables, tmp_out):
    from crashlens.plans.report import main
    paths = {}
    for name, df in tables.as_dict().items():
        paths[name] = os.path.join(tmp_out, "in", name)
        df.write.option("header", True).csv(paths[name])
    out = os.path.join(tmp_out, "out")
    main(["--person", paths["person"], "--units", paths["units"], "--damages", paths["damages"], "--out", out])
    status = {r.analysis: r for r in spark.read.json(os.path.join(out, "_report")).collect()}
    assert all(r.status == "success" for r in status.values())
    assert {k: status[k].n for k in ("a01_crashes_male_deaths", "a02_two_wheelers", "a04_hit_and_run_licensed",
                                     "a09_no_damage_high_severity")} == {
        "a01_crashes_male_deaths": 7, "a02_two_wheelers": 384, "a04_hit_and_run_licensed": 1853,
        "a09_no_damage_high_severity": 384}
    rows = lambda name: sorted(r[0] for r in read_result(spark, status[name].path).collect())
    assert rows("a08_zips_alcohol") == sorted(["07844", "07838", "07817", "07811", "07822"])
    assert rows("a10_speeding_makes_top_colour_state") == sorted(["FORD", "CHEVROLET", "TOYOTA", "DODGE", "HONDA"])


def test_rows_with_a_null_make_are_counted(spark, tables, tmp_out):
    bare = CrashTables(person=tables.person, damages=tables.damages,
                       units=tables.units.withColumn("VEH_MAKE_ID", F.when(F.col("CRASH_ID") % 2 == 0, F.col("VEH_MAKE_ID"))))
    want = A.a06_makes_injury_rank_3_5(bare).collect()
    assert any(r.VEH_MAKE_ID is None for r in want)
    status = {r.analysis: r for r in run_report(spark, bare, tmp_out).collect()}
    assert status["a06_makes_injury_rank_3_5"].n == len(want)
    back = read_result(spark, status["a06_makes_injury_rank_3_5"].path).collect()
    assert Counter(map(tuple, back)) == Counter(map(tuple, want))


def test_report_leaves_nothing_staged(spark, tables, tmp_out, monkeypatch):
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    run_report(spark, tables, tmp_out)
    assert len(made) == 5 and not any(os.path.exists(p.removeprefix("file:")) for p in made)
