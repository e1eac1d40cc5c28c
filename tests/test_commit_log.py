"""The report goes on where a killed job stopped, and leaves nothing of it behind."""

import os

import pytest

from crashlens.plans import report
from crashlens.plans.commit_log import CommitLog
from crashlens.plans.report import run_report
from crashlens.session import scratch_path
from crashlens.sources import catalog
from crashlens.sources.sink import read_result


class Killed(BaseException):
    """What no analysis may catch: the driver is gone."""


def files_of(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names}


def watched(monkeypatch, stop_after=None):
    """The names of the analyses that run, in order; the job is killed after ``stop_after`` of them."""
    ran = []

    def wrapped(real):
        def run(name, *rest):
            if len(ran) == stop_after:
                raise Killed(name)
            ran.append(name)
            return real(name, *rest)

        return run

    monkeypatch.setattr(report, "_run_count", wrapped(report._run_count))
    monkeypatch.setattr(report, "_run_table", wrapped(report._run_table))
    return ran


def statuses(df):
    return {r.analysis: (r.kind, r.status, r.n, r.value, r.path) for r in df.collect()}


@pytest.mark.parametrize("stop_after", [4, 7])
def test_a_killed_report_is_resumed(spark, tables, tmp_out, monkeypatch, stop_after):
    staged = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: staged.append(scratch_path(s, name)) or staged[-1])
    monkeypatch.setattr(report, "unstage", lambda *a: None)  # a lost driver cleans up nothing
    with pytest.MonkeyPatch.context() as first:
        before = watched(first, stop_after)
        with pytest.raises(Killed):
            run_report(spark, tables, tmp_out, parallelism=1, retries=0, run_id="v1")
    assert len(before) == stop_after
    left_over = list(staged)
    assert all(os.path.exists(p.removeprefix("file:")) for p in left_over)
    # What a job that died while writing leaves: an attempt, and an output without a commit.
    for folder in ("_attempts/a08_zips_alcohol-1234", "a10_speeding_makes_top_colour_state.csv"):
        tables.damages.limit(3).write.csv(f"{tmp_out}/{folder}")
    kept = {f: os.stat(f).st_mtime_ns for name in before if name in report.TABLE_ANALYSES for f in files_of(f"{tmp_out}/{name}.csv")}

    monkeypatch.undo()
    with pytest.MonkeyPatch.context() as second:
        after = watched(second)
        got = statuses(run_report(spark, tables, tmp_out, parallelism=1, run_id="v1"))
    assert sorted(before + after) == sorted(got) and len(got) == 10
    assert {f: os.stat(f).st_mtime_ns for f in kept} == kept
    assert not any(os.path.exists(p.removeprefix("file:")) for p in left_over)
    assert sorted(os.listdir(tmp_out.removeprefix("file:"))) == sorted([*(f"{n}.csv" for n in report.TABLE_ANALYSES), "_commits"])
    whole = scratch_path(spark, "whole")
    want = statuses(run_report(spark, tables, whole))
    assert {n: s[:4] for n, s in got.items()} == {n: s[:4] for n, s in want.items()}
    for name in report.TABLE_ANALYSES:
        assert sorted(map(str, read_result(spark, got[name][4]).collect())) == sorted(map(str, read_result(spark, want[name][4]).collect()))


def test_all_committed_nothing_runs_and_another_run_starts_anew(spark, tables, tmp_out, monkeypatch):
    ran = watched(monkeypatch)
    first = statuses(run_report(spark, tables, tmp_out, run_id="v1"))
    assert len(ran) == 10
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: made.append(name) or scratch_path(s, name))
    assert statuses(run_report(spark, tables, tmp_out, run_id="v1")) == first
    assert len(ran) == 10 and not made  # nothing was staged either
    run_report(spark, tables, tmp_out, run_id="v2")
    run_report(spark, tables, tmp_out)
    assert len(ran) == 30


def test_failed_analyses_are_tried_again(spark, tables, tmp_out, monkeypatch):
    real = dict(report.COUNT_ANALYSES)
    monkeypatch.setitem(report.COUNT_ANALYSES, "a02_two_wheelers", lambda t: t.units.select("NO_SUCH_COLUMN"))
    assert statuses(run_report(spark, tables, tmp_out, run_id="v1"))["a02_two_wheelers"][1] == "error"
    monkeypatch.setitem(report.COUNT_ANALYSES, "a02_two_wheelers", real["a02_two_wheelers"])
    ran = watched(monkeypatch)
    assert statuses(run_report(spark, tables, tmp_out, run_id="v1"))["a02_two_wheelers"][1:3] == ("success", 384)
    assert ran == ["a02_two_wheelers"]


def test_a_half_written_commit_does_not_count(spark, tmp_out):
    log = CommitLog(spark, tmp_out, "v1")
    log.commit("one", {"n": 1})
    part = log._path(log.folder, "_commits", ".two.json-abc")
    log._fs.create(part, True).close()
    assert CommitLog(spark, tmp_out, "v1").committed() == {"one": {"n": 1}}
    assert CommitLog(spark, tmp_out, "v2").committed() == {}
    assert CommitLog(spark, tmp_out, "v1").recover({}) == {"one": {"n": 1}}
    assert not log._fs.exists(part)
