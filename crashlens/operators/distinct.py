"""Distinct whole rows of which only some columns are needed.

``df.distinct().select(...)`` shuffles every column of every row, since the
optimizer may not prune below a distinct. :func:`distinct_projection` shuffles
the needed columns and fingerprints of the row instead. :func:`distinct_rows`
keeps every column, but shuffles only the rows that may have a copy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.operators.joins import having_match

#: Bits of the map of hashes that occur more than once, in words of 64: a broadcast of half a million rows at most.
BITS = 1 << 25
#: Column types whose values the fingerprints tell apart exactly as ``distinct`` does.
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _values(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form in which equal values have equal bytes: -0.0 equals 0.0, and every NaN every other."""
    values = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(F.isnan(c), F.lit(float("nan")).cast(field.dataType)).otherwise(c + F.lit(0.0).cast(field.dataType))
        values.append(c)
    return values


def _comparable(df: DataFrame) -> list[Column]:
    """The values of ``df``, and which of them are NULL: Spark's hash skips NULLs, so their places are hashed too, as bits of numbers."""
    bits = [F.when(F.col(f"`{f.name}`").isNull(), F.lit(1 << i % 62).cast("long")).otherwise(F.lit(0).cast("long"))
            for i, f in enumerate(df.schema.fields)]
    return [*(reduce(Column.bitwiseOR, bits[i:i + 62]) for i in range(0, len(bits), 62)), *_values(df)]


def row_fingerprint(values: Sequence[Column]) -> tuple[Column, ...]:
    """64 bits of a row: a hash chain over its values."""
    return (F.xxhash64(F.lit("first"), *values),)


def row_check(values: Sequence[Column]) -> Column:
    """64 bits more, of a chain that runs the other way."""
    return F.xxhash64(F.lit("check"), *reversed(values))


@dataclass(frozen=True)
class Matched:
    """The rows of a table that have a partner in ``other`` by ``keys``, not yet joined."""

    rows: DataFrame
    other: DataFrame
    keys: Sequence[str]

    def joined(self) -> DataFrame:
        return having_match(self.rows, self.other, self.keys)

    def distinct(self) -> DataFrame:
        return self.joined().distinct()


def distinct_projection(df: DataFrame | Matched, keep: Sequence[str | Column],
                        fingerprint: Callable[[Sequence[Column]], tuple[Column, ...]] = row_fingerprint) -> DataFrame:
    """``df.distinct().select(*keep)`` by late materialisation: same rows, as a bag.

    ``keep`` are columns of ``df`` or named expressions over them. What is shuffled for a row is ``keep``, its
    64-bit fingerprint and the smallest and largest check value of its group;
    rows of a group are equal copies and collapse map-side. A group whose check
    values differ holds different rows under one fingerprint; only its rows
    are read again and made distinct as whole rows. Such groups are rare (10^9
    rows of equal ``keep`` give 0.03 of them, different ``keep`` none), so their
    broadcast is empty, and adaptive execution drops the second branch before it
    scans. Different rows of equal ``keep`` are taken for copies if both of their
    64-bit values agree: 10^13 of them give 10^-13 such pairs.

    The grouping hashes on everything kept and on the fingerprint, so a hot key
    with many distinct rows is spread over all tasks. Tables with nested
    columns, which these hashes need not tell apart as ``distinct`` does, are
    made distinct as whole rows. Of ``Matched`` rows, whose keys must be kept, the
    narrow ones are joined.
    """
    matched = df if isinstance(df, Matched) else None
    df = matched.rows if matched else df
    columns = [F.col(c) if isinstance(c, str) else c for c in keep]
    if not plain(df):
        return (matched or df).distinct().select(*columns)
    names = df.select(*columns).columns
    values = _comparable(df)
    marks = [mark.alias(f"_fp{i}") for i, mark in enumerate(fingerprint(values))]
    fps = [f"_fp{i}" for i in range(len(marks))]
    narrow = df.select(*columns, *marks, row_check(values).alias("_check"))
    if matched:
        if not set(matched.keys) <= {c for c in keep if isinstance(c, str)}:
            raise ValueError(f"keys {list(matched.keys)} are not all kept")
        narrow = having_match(narrow, matched.other, matched.keys)  # what is doubted below has a partner too, as its keys are kept
    grouped = narrow.groupBy(*(F.col(f"`{c}`") for c in names), *fps).agg(F.min("_check").alias("_low"), F.max("_check").alias("_high"))
    proven = grouped.where(F.col("_low") == F.col("_high")).select(*(F.col(f"`{c}`") for c in names))
    kept = [f"_kept{i}" for i in range(len(names))]
    doubted = grouped.where(F.col("_low") != F.col("_high")).select(
        *(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)), *(F.col(fp).alias(f"_d{fp}") for fp in fps))
    marked = df.select("*", *marks)
    same = reduce(Column.__and__, [F.col(fp) == F.col(f"_d{fp}") for fp in fps])
    for c, k in zip(columns, kept):
        same &= c.eqNullSafe(F.col(k))
    again = marked.join(F.broadcast(doubted), same, "left_semi").drop(*fps).distinct().select(*columns)
    return proven.unionByName(again)


def distinct_rows(df: DataFrame, bits: int = BITS) -> DataFrame:
    """``df.distinct()``, for a table that can be read again cheaply and whose rows mostly occur once.

    A row whose 64-bit hash no other row has is distinct as it stands. Hashes
    are counted as narrow rows; those that occur more than once set a bit in a
    map of ``bits`` bits, which every task gets. Rows whose bit is not set stay in
    their task, and only the others are shuffled and made distinct as whole rows.
    Equal rows have equal hashes, so a bit set for other rows too costs
    time, never a row; a map with all bits set makes this a plain ``distinct``.
    """
    if not plain(df):
        return df.distinct()
    hashed = df.withColumn(ROW_HASH, row_hash(df))
    once, doubted = by_copies(hashed, copies_map(hashed, bits), bits)
    return once.unionByName(doubted.distinct())


#: Name of the column with a row's hash.
ROW_HASH = "_row_hash"


def plain(df: DataFrame) -> bool:
    """Whether the hash tells rows of ``df`` apart as ``distinct`` does."""
    return bool(df.columns) and all(isinstance(f.dataType, _PLAIN) for f in df.schema.fields)


def row_hash(df: DataFrame) -> Column:
    """64 bits of a row, equal for equal rows."""
    return F.xxhash64(F.lit("row"), *_comparable(df))


def copies_map(hashed: DataFrame, bits: int = BITS) -> DataFrame:
    """``(_word, _bits)``: the map of hashes that occur more than once, ``bits`` / 64 rows at most; only ``ROW_HASH`` is read."""
    often = hashed.select(ROW_HASH).groupBy(ROW_HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    place, bit = _bit(bits)
    return often.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _bit(bits: int) -> tuple[Column, Column]:
    return F.pmod(F.col(ROW_HASH), F.lit(bits)), F.expr(f"shiftleft(1L, CAST(pmod({ROW_HASH}, {min(bits, 64)}) AS INT))")


def by_copies(hashed: DataFrame, words: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """The rows that occur once (values as ``distinct`` gives them) and those that may have copies, by a ``copies_map``; without ``ROW_HASH``."""
    rows = hashed.drop(ROW_HASH)
    place, bit = _bit(bits)
    marked = hashed.join(F.broadcast(words), F.shiftright(place, 6) == F.col("_word"), "left")
    doubted = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    values = [c.alias(f.name) for c, f in zip(_values(rows), rows.schema.fields)]  # distinct gives 0.0 for -0.0
    return marked.where(~doubted).select(*values), marked.where(doubted).select(*columns)
