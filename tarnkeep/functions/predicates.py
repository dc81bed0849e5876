"""Row predicates shared by the rules and the quality checks. Nulls never count as a violation."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_blank(column: Column, data_type: T.DataType | None = None) -> Column:
    """Null, or the empty string. Only text can be empty, so other known types test null alone."""
    if data_type is not None and not isinstance(data_type, T.StringType):
        return column.isNull()
    return column.isNull() | (column.cast("string") == "")


def out_of_range(
    column: Column, low: Any = None, high: Any = None, data_type: T.DataType | None = None
) -> Column:
    """Outside ``[low, high]``; either bound may be missing and both are themselves valid.

    Text compared with a numeric bound is read as a number where it is one.
    """
    numeric = any(isinstance(b, (int, float)) for b in (low, high))
    if numeric and isinstance(data_type, T.StringType):
        column = column.try_cast("double")
    tests = []
    if low is not None:
        tests.append(column < F.lit(low))
    if high is not None:
        tests.append(column > F.lit(high))
    return reduce(lambda a, b: a | b, tests, F.lit(False)) if tests else F.lit(False)


def not_matching(column: Column, pattern: str) -> Column:
    """The text form has no match for ``pattern``."""
    return ~column.cast("string").rlike(pattern)
