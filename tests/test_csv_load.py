"""CSV folders with several headers and bad records: every record in one table or the other, in one pass."""

import gzip
import os

import pytest
from pyspark.sql import types as T

from crashlens.plans import analyses as A
from crashlens.session import scratch_path
from crashlens.sources.catalog import read_csv_typed, read_tables
from crashlens.sources.csv_load import header_groups, load_csv, read_csv_mixed

TYPES = {"id": T.LongType(), "n": T.IntegerType(), "d": T.DateType()}


def put(folder, name, text):
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with (gzip.open(path, "wt", newline="") if name.endswith(".gz") else open(path, "w", newline="")) as fh:
        fh.write(text)


def test_files_are_grouped_by_header(spark, tmp_out):
    put(tmp_out, "a.csv", "id,n,zip\n1,2,01234\n")
    put(tmp_out, "b.csv", "zip,id,n\n00001,3,4\n")
    put(tmp_out, "c.csv.gz", "id,n,zip\n5,x,\n")
    put(tmp_out, "d.csv", "id,colour\r\n7,\"red, dark\"\r\n")
    put(tmp_out, "e.csv", "id,n,zip")  # a header and nothing else
    put(tmp_out, "f.csv", "")
    put(tmp_out, "_hidden.csv", "nothing\n1\n")
    groups = {g.columns: sorted(os.path.basename(f) for f in g.files) for g in header_groups(spark, tmp_out)}
    assert groups == {("id", "n", "zip"): ["a.csv", "c.csv.gz", "e.csv"], ("zip", "id", "n"): ["b.csv"], ("id", "colour"): ["d.csv"]}
    df = read_csv_mixed(spark, tmp_out, TYPES)
    assert dict(df.dtypes) == {"id": "bigint", "n": "int", "zip": "string", "colour": "string"}
    got = sorted((r.id, r.n, r.zip, r.colour) for r in df.collect())
    assert got == [(1, 2, "01234", None), (3, 4, "00001", None), (5, None, None, None), (7, None, None, "red, dark")]
    with pytest.raises(Exception):
        read_csv_typed(spark, tmp_out, TYPES).collect()
    assert [g.columns for g in header_groups(spark, f"{tmp_out}/b.csv")] == [("zip", "id", "n")]
    assert len(header_groups(spark, f"{tmp_out}/[ab].csv")) == 2


def test_bad_records_are_rescued(spark, tmp_out):
    put(tmp_out, "a.csv", 'id,n,d,s\n1,2,2020-01-31,ok\n2,two,2020-01-31,bad number\n3,3\n4,4,2020-01-31,x,too many\n'
        '5,,,\n6,99999999999,,too large\n7,7,31.01.2020,bad date\n8,8,2020-02-01,"a, quoted"\n,,,\n')
    put(tmp_out, "b.csv", "s,id\nmoved,9\nfew\nwrong,nine\n")
    load = load_csv(spark, tmp_out, TYPES)
    rows = sorted(((r.id, r.n, str(r.d), r.s) for r in load.rows.collect()), key=str)
    assert rows == sorted([(1, 2, "2020-01-31", "ok"), (5, None, "None", None), (8, 8, "2020-02-01", 'a, quoted'), (9, None, "None", "moved"),
                           (None, None, "None", None)], key=str)
    bad = sorted((os.path.basename(r._file), r._raw) for r in load.rescued.collect())
    assert bad == [("a.csv", "2,two,2020-01-31,bad number"), ("a.csv", "3,3"), ("a.csv", "4,4,2020-01-31,x,too many"),
                   ("a.csv", "6,99999999999,,too large"), ("a.csv", "7,7,31.01.2020,bad date"), ("b.csv", "few"), ("b.csv", "wrong,nine")]
    assert load.rows.columns == ["id", "n", "d", "s"] and len(load.groups) == 2
    where = load.path.removeprefix("file:")
    assert os.path.isdir(where)
    load.remove()
    assert not os.path.exists(where)


def test_the_text_is_parsed_once(spark, tmp_out):
    put(tmp_out, "a.csv", "id,n\n1,1\n2,x\n")
    told = []
    load = load_csv(spark, tmp_out, TYPES, announce=told.append)
    assert told == [load.path]
    for df in (load.rows, load.rescued):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "csv" not in plan.lower().replace("csv-load", "")
    os.remove(os.path.join(tmp_out.removeprefix("file:"), "a.csv"))
    assert (load.rows.count(), load.rescued.count()) == (1, 1)


def test_many_splits_lose_nothing(spark, tmp_out):
    lines = [f"{i},{'x' if i % 10 == 0 else i},{'long text ' * (i % 20)}" for i in range(20_000)]
    put(tmp_out, "a.csv", "id,n,s\n" + "\n".join(lines[:15_000]) + "\n")
    put(tmp_out, "b.csv", "id,n,s\n" + "\n".join(lines[15_000:]) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        load = load_csv(spark, tmp_out, TYPES)
        assert load.rows.count() == 18_000 and load.rescued.count() == 2_000
        assert sorted(r.id for r in load.rows.select("id").collect()) == [i for i in range(20_000) if i % 10]
        assert sorted(r._raw for r in load.rescued.collect()) == sorted(x for i, x in enumerate(lines) if i % 10 == 0)
    finally:
        spark.conf.set(key, before)


def test_no_files_is_an_error(spark, tmp_out):
    put(tmp_out, "empty.csv", "")
    for read in (read_csv_mixed, load_csv):
        with pytest.raises(ValueError, match="no CSV files"):
            read(spark, tmp_out)
    put(tmp_out, "endless.csv", "x" * 70_000)
    with pytest.raises(ValueError, match="no header line"):
        header_groups(spark, tmp_out)


def test_analyses_on_tables_with_several_headers(spark, tables):
    paths = {}
    for name, df in tables.as_dict().items():
        paths[name] = scratch_path(spark, f"mixed-{name}")
        for i, part in enumerate((df.columns, df.columns[::-1])):
            df.filter(f"CRASH_ID % 2 = {i}").select(*part).write.mode("append").option("header", True).csv(paths[name])
    t = read_tables(spark, paths, mixed=True)
    assert A.a08_zips_alcohol(t, with_counts=True).collect() == A.a08_zips_alcohol(tables, with_counts=True).collect()
    assert A.a02_two_wheelers(t).first().n == 384
