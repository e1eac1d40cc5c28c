"""Staged files are reused while they are unchanged; only new ones are parsed; leases keep batches from being removed."""

import os

import pytest
from pyspark.sql import types as T

from crashlens.plans import analyses as A
from crashlens.plans.report import run_report
from crashlens.session import scratch_path
from crashlens.sources.catalog import read_csv_typed
from crashlens.sources.stage_store import StageStore, load_tables

TYPES = {"id": T.LongType(), "n": T.IntegerType()}


def put(folder, name, text, at=None):
    path = os.path.join(folder.removeprefix("file:"), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    if at:
        os.utime(path, (at, at))


def rows(staged):
    return sorted(map(tuple, staged.rows.collect()), key=str)


@pytest.fixture
def store(spark, tmp_out):
    return StageStore(spark, f"{tmp_out}/store")


def test_only_new_files_are_staged(spark, tmp_out, store):
    src = f"{tmp_out}/src"
    put(src, "a.csv", "id,n,s\n1,2,x\n2,bad,\n", 1000)
    put(src, "b.csv", "id,n,s\n3,4,y\n", 1000)
    first = store.load(src, TYPES)
    assert (first.reused, [os.path.basename(f) for f in first.new]) == (0, ["a.csv", "b.csv"])
    assert rows(first) == sorted(map(tuple, read_csv_typed(spark, src, TYPES).collect()), key=str)
    again = store.load(src, TYPES)
    assert (again.reused, again.new, rows(again)) == (2, (), rows(first)) and len(store.manifests()) == 1
    put(src, "c.csv", "s,id\nz,5\n", 1000)  # a new file with a header of its own
    third = store.load(src, TYPES)
    assert (third.reused, [os.path.basename(f) for f in third.new]) == (2, ["c.csv"])
    assert rows(third) == sorted([*rows(first), (5, None, "z")], key=str)
    assert not [f for f in third.rows.inputFiles() if f.endswith(".csv")]
    put(src, "a.csv", "id,n,s\n9,9,w\n", 2000)  # changed
    os.remove(f"{src.removeprefix('file:')}/c.csv")  # gone
    fourth = store.load(src, TYPES)
    assert (fourth.reused, [os.path.basename(f) for f in fourth.new]) == (1, ["a.csv"])
    assert rows(fourth) == [(3, 4, "y"), (9, 9, "w")]
    other = store.load(src, {"id": T.StringType()})  # read in another way
    assert other.reused == 0 and ("3", "4", "y") in rows(other)


def test_a_batch_without_a_manifest_does_not_count(spark, tmp_out, store):
    src = f"{tmp_out}/src"
    put(src, "a.csv", "id\n1\n")
    first = store.load(src, TYPES)
    name = next(iter(store.manifests()))
    store._fs.delete(store._path("batches", name, "manifest.json"), False)  # as if the job had died before its commit
    second = store.load(src, TYPES)
    assert second.reused == 0 and rows(second) == rows(first) == [(1,)]


def test_leases_keep_batches(spark, tmp_out, store):
    src = f"{tmp_out}/src"
    put(src, "a.csv", "id\n1\n", 1000)
    old = store.load(src, TYPES)
    put(src, "a.csv", "id\n2\n", 2000)
    new = store.load(src, TYPES, seconds=100)
    assert len(store.manifests()) == 2 and store.clean() == []
    store.release(old)
    assert len(store.clean()) == 1 and rows(new) == [(2,)]
    store._write({"until": 10**12, "batches": None}, "leases", "choosing")  # a job that has not chosen yet keeps all
    store.release(new)
    assert store.clean() == []
    store._fs.delete(store._path("leases", "choosing"), False)
    third = store.load(src, TYPES, seconds=50)
    assert third.reused == 1
    import time

    assert store.clean(time.time() + 60) == list(store.manifests()) or not store.manifests()
    assert not store.manifests()


def test_a_second_report_reads_only_the_new_file(spark, tables, tmp_out, store):
    paths = {}
    for name, df in tables.as_dict().items():
        paths[name] = scratch_path(spark, f"store-{name}")
        df.filter("CRASH_ID % 5 <> 0").coalesce(2).write.option("header", True).csv(paths[name])
    t, loads = load_tables(store, paths)
    assert all(load.reused == 0 for load in loads.values())
    for name, df in tables.as_dict().items():
        df.filter("CRASH_ID % 5 = 0").coalesce(1).write.mode("append").option("header", True).csv(paths[name])
    t, loads = load_tables(store, paths)
    assert all(len(load.new) == 1 and load.reused >= 1 for load in loads.values())
    for name in ("person", "units", "damages"):
        assert not [f for f in t.as_dict()[name].inputFiles() if f.endswith(".csv")]
    assert A.a08_zips_alcohol(t, with_counts=True).collect() == A.a08_zips_alcohol(tables, with_counts=True).collect()
    status = {r.analysis: r.n for r in run_report(spark, t, f"{tmp_out}/out", stage_tables=False).collect()}
    assert (status["a01_crashes_male_deaths"], status["a02_two_wheelers"], status["a04_hit_and_run_licensed"]) == (7, 384, 1853)
