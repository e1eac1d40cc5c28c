"""Column-level helpers, all built from JVM-side ``pyspark.sql.functions``.

Nothing here is a Python UDF: every helper returns a ``Column`` expression,
so it stays inside whole-stage codegen and can be pushed down by Catalyst.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# First run of ASCII digits. ``[0-9]`` rather than ``\d`` keeps the pattern
# identical in the DuckDB oracle.
DIGITS = r"([0-9]+)"


def first_int(col: str | Column) -> Column:
    """First digit run of a text as int: 0 if there is none, NULL for NULL.

    ``try_cast`` gives NULL for a run too long for an int instead of failing
    the query under ANSI mode.
    """
    c = F.col(col) if isinstance(col, str) else col
    digits = F.regexp_extract(c, DIGITS, 1)
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))


def first_digits(col: str | Column) -> Column:
    """First digit run of a text as a string ('' if none, NULL for NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, DIGITS, 1)


def is_true(predicate: Column) -> Column:
    """Collapse three-valued logic to two: NULL counts as false.

    A filter keeps a row only when its predicate is TRUE, so
    ``filter(p)`` == ``filter(is_true(p))``; the two-valued form is what a
    flag column needs when it is later combined with ``OR`` across a join.
    """
    return F.coalesce(predicate, F.lit(False))


def any_of(columns: Iterable[str], predicate: Callable[[Column], Column]) -> Column:
    """``predicate(c1) OR predicate(c2) OR ...`` (three-valued, like SQL)."""
    return reduce(lambda a, b: a | b, (predicate(F.col(c)) for c in columns))


def not_in(col: str, values: Iterable[str]) -> Column:
    """SQL ``NOT IN``: a NULL value is unknown, so the row is dropped by a filter."""
    return ~F.col(col).isin(list(values))


__all__ = ["DIGITS", "any_of", "first_digits", "first_int", "is_true", "not_in"]
