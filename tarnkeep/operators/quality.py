"""Declarative quality checks; all checks of a table share one aggregation over one scan."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.functions.names import named
from tarnkeep.functions.predicates import is_blank, not_matching, out_of_range
from tarnkeep.operators.states import distinct_of, one_row, states, value_of

REPORT = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("expected", T.DoubleType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("total_rows", T.LongType()),
])


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def null_percentage_of(df: DataFrame, column: str) -> Column:
    """Null-or-empty share in percent; 0 for an empty table."""
    blank = F.count_if(is_blank(named(column), _type_of(df, column)))
    return F.coalesce(F.try_divide(blank, F.count(F.lit(1))) * 100.0, F.lit(0.0))


def distinct_count_of(columns: Sequence[str]) -> Column:
    """Distinct values or value combinations; null counts as a value."""
    if len(columns) == 1:
        column = named(columns[0])
        has_null = F.coalesce(F.max(column.isNull().cast("bigint")), F.lit(0))
        return F.count_distinct(column) + has_null
    return F.count_distinct(F.struct(*[named(c) for c in columns]))


def range_violations_of(df: DataFrame, column: str, low: Any = None, high: Any = None) -> Column:
    return F.count_if(out_of_range(named(column), low, high, _type_of(df, column)))


def regex_violations_of(column: str, pattern: str) -> Column:
    return F.count_if(not_matching(named(column), pattern))


def null_percentage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(null_percentage_of(df, column).alias("null_pct"))


def distinct_count(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    columns = [columns] if isinstance(columns, str) else columns
    return df.agg(distinct_count_of(columns).alias("distinct_count"))


def value_range_violations(
    df: DataFrame, column: str, low: Any = None, high: Any = None
) -> DataFrame:
    return df.agg(range_violations_of(df, column, low, high).alias("violations"))


def regex_violations(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.agg(regex_violations_of(column, pattern).alias("violations"))


class _Unusable(Exception):
    """The check cannot be evaluated; the text becomes the error of its report row."""


def _need(check: Mapping[str, Any], field: str) -> Any:
    value = check.get(field)
    if value is None:
        raise _Unusable(f"check has no {field}")
    return value


def _columns_of(df: DataFrame, check: Mapping[str, Any]) -> list[str]:
    columns = check.get("columns") or check.get("column")
    if columns is None:
        raise _Unusable("check names no column")
    columns = [columns] if isinstance(columns, str) else list(columns)
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise _Unusable(f"unknown column: {', '.join(unknown)}")
    return columns


def _number(value: Any, what: str) -> float:
    try:
        return float(value)
    except (TypeError, ValueError):
        raise _Unusable(f"{what} is no number: {value}") from None


def _bound(df: DataFrame, column: str, value: Any) -> Any:
    """The bound, if values of the column can be compared with it."""
    kind = df.schema[column].dataType
    if value is None:
        return None
    if isinstance(kind, T.NumericType):
        _number(value, "bound")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        try:
            datetime.fromisoformat(str(value))
        except ValueError:
            raise _Unusable(f"bound is no date: {value}") from None
    elif isinstance(kind, T.StringType) and not isinstance(value, str):
        raise _Unusable(f"bound is no text: {value}")
    return value


def _pattern(df: DataFrame, pattern: Any) -> str:
    try:
        df.sparkSession.range(1).select(F.rlike(F.lit(""), F.lit(str(pattern)))).collect()
    except PySparkException as error:
        raise _Unusable(f"bad pattern: {pattern}") from error
    return str(pattern)


def _evaluate(df: DataFrame, check: Mapping[str, Any]) -> tuple[Column, float, str]:
    """The aggregate to measure, what it is compared with, and how."""
    kind = check.get("type")
    if kind == "row_count_gt":
        return F.count(F.lit(1)), check.get("value", 0), ">"
    if kind == "null_pct_lt":
        return null_percentage_of(df, _columns_of(df, check)[0]), _need(check, "threshold"), "<"
    if kind == "unique_keys" and check.get("approximate"):
        # a sketch of fixed size instead of a shuffle of all distinct keys; nulls as in the exact form
        keys = F.struct(*_columns_of(df, check))
        return F.approx_count_distinct(keys), check.get("expected", 1), ">="
    if kind == "unique_keys":
        return distinct_count_of(_columns_of(df, check)), check.get("expected", 1), ">="
    if kind == "no_duplicate_keys":
        return F.count(F.lit(1)) - distinct_count_of(_columns_of(df, check)), 0, "="
    if kind == "value_range":
        column = _columns_of(df, check)[0]
        low, high = (_bound(df, column, check.get(side)) for side in ("min", "max"))
        return range_violations_of(df, column, low, high), 0, "="
    if kind == "regex":
        column, pattern = _columns_of(df, check)[0], _pattern(df, _need(check, "pattern"))
        return regex_violations_of(column, pattern), 0, "="
    raise _Unusable("unknown check type")


_COMPARE = {
    ">": Column.__gt__, "<": Column.__lt__, ">=": Column.__ge__, "=": Column.__eq__,
}


def _assembled(
    checks: Sequence[Mapping[str, Any]],
    table_name: str | None,
    total: Column,
    evaluate: Callable[[Mapping[str, Any]], tuple[Column, float, str]],
) -> tuple[list[Column], list[Column]]:
    """The measures of the checks, and their report rows in terms of them."""
    measures = [total.alias("__total")]
    rows = []
    for position, check in enumerate(checks):
        kind = check.get("type")
        fields = {
            "table": F.lit(table_name),
            "check": F.lit(check.get("name") or kind),
            "type": F.lit(kind),
            "column": F.lit(check.get("column")),
            "total_rows": F.col("__total"),
        }
        try:
            measure, expected, comparison = evaluate(check)
            expected = F.lit(_number(expected, "expected value"))
        except _Unusable as reason:
            fields |= {"passed": F.lit(False), "error": F.lit(str(reason))}
        else:
            name = f"__m{position}"
            measures.append(measure.cast("double").alias(name))
            fields |= {
                "expected": expected,
                "actual": F.col(name),
                "passed": _COMPARE[comparison](F.col(name), expected),
            }
        rows.append(F.struct(*[
            fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REPORT
        ]))
    return measures, rows


def run_checks(
    df: DataFrame, checks: Sequence[Mapping[str, Any]], table_name: str | None = None
) -> DataFrame:
    """One report row per check, from one aggregation over ``df``.

    A check that cannot be evaluated gets a failed row with the reason; the others still run.
    """
    measures, rows = _assembled(checks, table_name, F.count(F.lit(1)), lambda c: _evaluate(df, c))
    if not rows:
        return df.sparkSession.createDataFrame([], REPORT)
    return df.agg(*measures).select(F.inline(F.array(*rows)))


class CheckStates:
    """The checks of a table as mergeable states (see :mod:`tarnkeep.operators.states`).

    ``sample`` is a table of the checked one's schema; its rows are not read. Distinct counts are exact:
    over keys, or over bitmaps for a check with ``dense`` (one whole-number column); with ``approximate``
    they are estimated from sketches.
    """

    def __init__(self, sample: DataFrame, checks: Sequence[Mapping[str, Any]]) -> None:
        self._sample, self._checks = sample, checks
        self._sums: dict[str, Column] = {"rows": F.count(F.lit(1))}
        self._keys: dict[str, Sequence[str]] = {}
        self._dense: dict[str, str] = {}
        self._sketches: dict[str, Sequence[str]] = {}
        for position, check in enumerate(checks):
            with suppress(_Unusable):
                self._define(f"c{position}", check)

    def _define(self, name: str, check: Mapping[str, Any]) -> None:
        df, kind = self._sample, check.get("type")
        if kind == "null_pct_lt":
            column = _columns_of(df, check)[0]
            self._sums[name] = F.count_if(is_blank(named(column), _type_of(df, column)))
        elif kind in ("unique_keys", "no_duplicate_keys"):
            columns = _columns_of(df, check)
            if check.get("approximate") and kind == "unique_keys":
                self._sketches[name] = columns
            elif check.get("dense"):
                if len(columns) > 1 or not isinstance(_type_of(df, columns[0]), T.IntegralType):
                    raise _Unusable("dense keys are one whole-number column")
                self._dense[name] = columns[0]
            else:
                self._keys[name] = columns
        elif kind in ("value_range", "regex"):
            self._sums[name] = _evaluate(df, check)[0]

    @property
    def signature(self) -> str:
        return json.dumps([list(self._checks), self._sample.schema.jsonValue()], sort_keys=True, default=str)

    def of(self, df: DataFrame) -> DataFrame:
        """The states of each part of ``df``, named in ``__part``."""
        return states(df, self._sums, None, self._keys, self._dense, self._sketches)

    def _measure(self, position: int, check: Mapping[str, Any]) -> tuple[Column, float, str]:
        name, kind, rows = f"c{position}", check.get("type"), value_of("rows")
        if kind not in ("unique_keys", "no_duplicate_keys"):
            _, expected, comparison = _evaluate(self._sample, check)
            if kind == "row_count_gt":
                return rows, expected, comparison
            if kind == "null_pct_lt":
                share = F.coalesce(F.try_divide(value_of(name), rows) * 100.0, F.lit(0.0))
                return share, expected, comparison
            return value_of(name), expected, comparison
        self._define(name, check)
        if kind == "unique_keys":
            return distinct_of(name), check.get("expected", 1), ">="
        return rows - distinct_of(name), 0, "="

    def report(self, rows: DataFrame, table_name: str | None = None) -> DataFrame:
        """The report out of state rows of any parts, as :func:`run_checks` gives it over all rows."""
        position = {id(c): i for i, c in enumerate(self._checks)}
        measures, out = _assembled(
            self._checks, table_name, value_of("rows"), lambda c: self._measure(position[id(c)], c)
        )
        if not out:
            return rows.sparkSession.createDataFrame([], REPORT)
        return one_row(rows).select(*measures).select(F.inline(F.array(*out)))


def run_checks_on_table(
    spark: SparkSession, table: str, checks: Sequence[Mapping[str, Any]]
) -> DataFrame:
    """The report on a table; if it can't be read, every check has a failed row that says so."""
    try:
        df = spark.table(table)
    except AnalysisException as error:
        reason = f"table can't be read: {error.getCondition() or table}"
        rows = [
            {"table": table, "check": c.get("name") or c.get("type"), "type": c.get("type"),
             "column": c.get("column"), "passed": False, "error": reason}
            for c in checks
        ]
        return spark.createDataFrame([[r.get(n) for n in REPORT.names] for r in rows], REPORT)
    return run_checks(df, checks, table)


def read_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """A configuration from a JSON file at any path that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def run_config(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The report over every table of a configuration ``{"tables": [{"table", "checks"}]}``."""
    reports = [
        run_checks_on_table(spark, entry["table"], entry.get("checks", []))
        for entry in config.get("tables", [])
    ]
    if not reports:
        return spark.createDataFrame([], REPORT)
    return reduce(DataFrame.unionByName, reports)
