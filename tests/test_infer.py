"""Types inferred from mergeable states: nothing of a value is lost, states of parts merge to the state of the whole."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from crashlens.sources.infer import column_states, merge_states, read_csv_safe_inferred, types_of

CASES = {
    "zip": (["01234", "78521"], "string"), "zero": (["0", "7"], "int"), "code": (["1E5", "200"], "string"), "minus_zero": (["-0", "1"], "string"),
    "plus": (["+1", "2"], "string"), "blank": ([" 1", "2"], "string"), "word": (["NA", "98"], "string"), "small": (["-2147483648", "2147483647"], "int"),
    "large": (["2147483648", None], "bigint"), "huge": (["9223372036854775808", "1"], "decimal(38,0)"), "endless": (["1" * 39, "1"], "string"),
    "price": (["1.50", "-0.25"], "double"), "mixed": (["1.5", "2"], "double"), "exact": (["12345678901234.125", "1"], "decimal(17,3)"),
    "dotless": ([".5", "1"], "string"), "truth": (["true", "FALSE"], "boolean"), "day": (["2020-02-29", "1999-12-31"], "date"),
    "no_day": (["2021-02-29", "1999-12-31"], "string"), "time": (["2020-02-29 10:00:00", "2020-01-01T00:00:00.5"], "timestamp"),
    "nothing": ([None, None], "string"), "leading": (["00.5", "1.0"], "string"), "a b": (["1", "2"], "int"),
}


def test_the_narrowest_type_that_loses_nothing(spark):
    rows = list(zip(*[v for v, _ in CASES.values()]))
    raw = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in CASES]))
    assert {c: t.simpleString() for c, t in types_of(column_states(raw)).items()} == {c: t for c, (_, t) in CASES.items()}


def test_states_of_parts_merge(spark):
    rows = [(str(i), "0" + str(i) if i > 7 else str(i), None if i < 5 else "x") for i in range(10)] + [("3000000000", "1.5", "1")]
    raw = spark.createDataFrame(rows, "a string, b string, c string")
    whole = sorted(map(tuple, column_states(raw).collect()))
    for cut in (1, 5, 8):
        parts = [spark.createDataFrame(p, raw.schema) for p in (rows[:cut], rows[cut:])]
        assert sorted(map(tuple, merge_states([column_states(p) for p in parts]).collect())) == whole
    lacking = merge_states([column_states(raw), column_states(raw.select("a"))])
    assert {c: t.simpleString() for c, t in types_of(lacking).items()} == {"a": "bigint", "b": "string", "c": "string"}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.from_regex(r"\A-?0?[0-9]{1,20}(\.[0-9]{1,4})?\Z"), st.sampled_from(["NA", "1e3", "true", "2020-01-01"])), min_size=1, max_size=6))
def test_every_value_comes_back(spark, values):
    raw = spark.createDataFrame([(v,) for v in values], "v string")
    kind = types_of(column_states(raw))["v"]
    back = [r.v for r in raw.select(raw.v.cast(kind).cast("string").alias("v")).collect()]
    for v, b in zip(values, back):
        if v is None or kind == T.StringType() or isinstance(kind, (T.BooleanType, T.DateType)):
            assert b == v
        elif isinstance(kind, T.DoubleType):
            assert float(b) == float(v) and len(v.replace("-", "").replace(".", "")) <= 15 + 4
        else:
            assert (b.rstrip("0").rstrip(".") if "." in b else b) == (v.rstrip("0").rstrip(".") if "." in v else v)


def test_csv_files_with_and_without_known_states(spark, tmp_out):
    folder = tmp_out.removeprefix("file:")
    for name, text in {"a/1.csv": "id,zip\n1,01234\n", "a/2.csv": "zip,id,n\n99999,2,\n", "b/1.csv": "id,zip\n5,70000\n6,70001\n"}.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(text)
    first = read_csv_safe_inferred(spark, f"{tmp_out}/a")
    assert dict(first.dtypes) == {"id": "int", "zip": "string", "n": "string"}
    assert sorted((r.id, r.zip) for r in first.collect()) == [(1, "01234"), (2, "99999")]
    alone = read_csv_safe_inferred(spark, f"{tmp_out}/b")
    assert dict(alone.dtypes) == {"id": "int", "zip": "int"}
    known = column_states(spark.createDataFrame([("1", "01234")], "id string, zip string"))
    assert dict(read_csv_safe_inferred(spark, f"{tmp_out}/b", known=known).dtypes) == {"id": "int", "zip": "string"}


def test_one_pass(spark):
    raw = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = column_states(raw)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1
    with pytest.raises(ValueError):
        read_csv_safe_inferred(spark, "/nowhere/at/all")


def test_the_code_of_a_state_does_not_grow_with_the_columns(spark):
    """Huge methods are not compiled; values are aggregated by the place of their column."""
    sizes = []
    for n in (2, 60):
        raw = spark.createDataFrame([tuple("7" for _ in range(n))], ", ".join(f"c{i} string" for i in range(n)))
        states = column_states(raw)
        assert {t.simpleString() for t in types_of(states).values()} == {"int"} and states.count() == n
        sizes.append(states._jdf.queryExecution().optimizedPlan().toString().count("RLIKE"))
    assert sizes[0] == sizes[1]


def test_an_empty_table_has_a_state_for_each_column(spark):
    got = column_states(spark.createDataFrame([], "a string, b string")).collect()
    assert sorted(tuple(r) for r in got) == [(c, 0, *[None] * 9) for c in "ab"]
