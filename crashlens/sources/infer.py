"""Column types of CSV files from one pass whose states merge.

Spark's own inference reads ``01234`` as the number 1234 and ``1E5`` as a
double, which destroys zips and codes. Here each column gets a small state (how many
values, whether all of them are written as a whole number, a decimal, a
truth value, a date or a time, and within which bounds), made by partial aggregates on
the executors. States of file sets merge, so new files need no second look at old
ones. The narrowest type that gives every value back as it was written, but for
zeros at the end of decimals, is the column's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.sources.csv_load import read_csv_mixed

# Patterns of values as they are written: no leading zeros, signs that mean nothing, blanks or exponents.
WHOLE = r"^(0|-?[1-9][0-9]*)$"
DECIMAL = r"^(0|-?[1-9][0-9]*|-?(0|[1-9][0-9]*)\.[0-9]+)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
EXACT_DIGITS = 15  # a double holds any decimal of so many digits
MOST_DIGITS = 38  # of a decimal

STATE = "column string, n long, whole boolean, low decimal(38,0), high decimal(38,0), decimal boolean, before int, behind int, truth boolean, date boolean, time boolean"


# How a value is written, as a bit; a column's bits are or-ed.
_WHOLE, _DECIMAL, _TRUTH, _DATE, _TIME, _TEXT = (1 << i for i in range(6))
LONG_DIGITS = 18  # a long holds any whole number of so many digits


def _kind(c: Column) -> Column:
    """The bit of a value, NULL for NULL; a whole number beyond ``MOST_DIGITS`` counts as a decimal.

    Patterns are tried one after the other, and only on values that start as a number.
    """
    fits = F.length(_digits(c)) <= MOST_DIGITS
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(~F.substring(c, 1, 1).isin(*"-0123456789"), F.when(F.lower(c).isin("true", "false"), _TRUTH).otherwise(_TEXT))
        .when(c.rlike(WHOLE), F.when(fits, _WHOLE).otherwise(_DECIMAL))
        .when(c.rlike(DECIMAL), _DECIMAL)
        .when(c.rlike(DATE), F.when(c.try_cast("date").isNotNull(), _DATE).otherwise(_TEXT))
        .when(c.rlike(TIME), F.when(c.try_cast("timestamp").isNotNull(), _TIME).otherwise(_TEXT))
        .otherwise(_TEXT)
    )


def _digits(c: Column) -> Column:
    return F.when(c.startswith("-"), F.substring(c, 2, 1 << 30)).otherwise(c)


def _aggregates() -> list[Column]:
    """What is aggregated over the ``_value`` and its ``_kind`` of one column."""
    c, kind = F.col("_value"), F.col("_kind")
    digits, short = _digits(c), F.length(c) <= LONG_DIGITS
    number = kind.isin(_WHOLE, _DECIMAL)
    small, large = F.when((kind == _WHOLE) & short, c.try_cast("long")), F.when((kind == _WHOLE) & ~short, c.try_cast("decimal(38,0)"))
    behind = F.when(kind == _WHOLE, 0).when(kind == _DECIMAL, F.when(c.contains("."), F.length(F.substring_index(digits, ".", -1))).otherwise(0))
    return [
        F.count(c).alias("n"), F.bit_or(kind).alias("kinds"), F.min(small).alias("low"), F.max(small).alias("high"),
        F.min(large).alias("low_large"), F.max(large).alias("high_large"),
        F.max(F.when(number, F.length(F.substring_index(digits, ".", 1)))).alias("before"), F.max(behind).alias("behind"),
    ]


def _only(*bits: int) -> Column:
    return F.col("kinds").bitwiseOR(F.lit(sum(bits))) == sum(bits)


def column_states(raw: DataFrame) -> DataFrame:
    """One row per column of an all-string table: its state, from one pass over the rows.

    Values are aggregated by the place of their column, so the code that does it
    is short, however many columns there are, and gets compiled.
    """
    if not raw.columns:
        return raw.sparkSession.createDataFrame([], STATE)
    values = raw.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in raw.columns])).alias("_place", "_value"))
    places = raw.sparkSession.range(len(raw.columns)).select(F.col("id").cast("int").alias("_place"), F.lit(None).cast("string").alias("_value"))
    values = values.unionByName(places)  # a column of a table without rows has a state too
    found = values.select("*", _kind(F.col("_value")).alias("_kind")).groupBy("_place").agg(*_aggregates())
    name = F.element_at(F.array(*[F.lit(c) for c in raw.columns]), F.col("_place") + 1)
    large = lambda c: F.col(c).cast("decimal(38,0)")
    return found.select(
        name.alias("column"), "n", _only(_WHOLE).alias("whole"),
        F.least(large("low"), "low_large").alias("low"), F.greatest(large("high"), "high_large").alias("high"),
        _only(_WHOLE, _DECIMAL).alias("decimal"), "before", "behind", _only(_TRUTH).alias("truth"), _only(_DATE).alias("date"), _only(_TIME).alias("time"))


def merge_states(states: Sequence[DataFrame]) -> DataFrame:
    """The states of all rows that ``states`` were made of; a column that one of them lacks counts as all NULL there."""
    both = reduce(DataFrame.unionByName, states)
    every = [F.bool_and(c).alias(c) for c in ("whole", "decimal", "truth", "date", "time")]
    most = [F.max(c).alias(c) for c in ("high", "before", "behind")]
    merged = both.groupBy("column").agg(F.sum("n").alias("n"), F.min("low").alias("low"), *every, *most)
    return merged.select(*[f.name for f in both.schema.fields])


def types_of(states: DataFrame) -> dict[str, T.DataType]:
    """The type of each column by its state (one small row per column comes to the driver)."""
    return {s["column"]: _type(s) for s in states.collect()}


def _type(s) -> T.DataType:
    if not s["n"]:
        return T.StringType()
    if s["truth"]:
        return T.BooleanType()
    if s["whole"]:
        for kind, bits in ((T.IntegerType(), 31), (T.LongType(), 63)):
            if -(1 << bits) <= s["low"] and s["high"] < 1 << bits:
                return kind
        return T.DecimalType(MOST_DIGITS, 0)
    if s["decimal"] and s["before"] + s["behind"] <= EXACT_DIGITS:
        return T.DoubleType()
    if s["decimal"] and s["before"] + s["behind"] <= MOST_DIGITS:
        return T.DecimalType(s["before"] + s["behind"], s["behind"])
    if s["date"]:
        return T.DateType()
    if s["time"]:
        return T.TimestampType()
    return T.StringType()


def read_csv_safe_inferred(spark: SparkSession, path: str, sep: str = ",", known: DataFrame | None = None) -> DataFrame:
    """Headed CSV (headers may differ) with inferred types that lose nothing of zips and codes.

    ``known`` are states of files read earlier, whose rows then must fit the
    types too. Columns without a value are strings.
    """
    raw = read_csv_mixed(spark, path, sep=sep)
    states = column_states(raw)
    types = types_of(merge_states([known, states]) if known is not None else states)
    return raw.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in raw.columns])
