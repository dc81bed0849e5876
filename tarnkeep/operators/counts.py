"""Row counts, cardinalities and the row-count log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.functions.names import named
from tarnkeep.operators.contracts import Contract, timestamp_literal
from tarnkeep.sinks.tables import append_by_position

CONTROL = Contract({
    "Table_name": "STRING",
    "Table_count": "DECIMAL(18,4)",
    "count_timestamp": "TIMESTAMP",
})


def row_count(df: DataFrame) -> int:
    return df.count()


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def distinct_text(field: T.StructField) -> Column:
    """A text that two values share exactly when grouping treats them as equal."""
    column = named(field.name)
    kind = field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit("0.0")).otherwise(column.cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.AtomicType):
        return column.cast("string")
    return F.to_json(F.struct(column), {"ignoreNullFields": "false"})


def column_cardinality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values of every column, null being one value: one row per column.

    The approximate form keeps one sketch per column instead of a row per distinct value, for
    tables whose key-like columns would send all their values through the shuffle.

    Values are turned into (column, text) pairs, so the shuffle carries one short pair per
    distinct value and task. A count(DISTINCT) per column would instead widen every row by
    every column.
    """
    pairs = [
        F.struct(
            F.lit(i).alias("position"),
            distinct_text(f).alias("value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    long = df.select(F.inline(F.array(*pairs)))
    if approximate:
        distinct = F.approx_count_distinct("value") + F.max(F.col("value").isNull().cast("bigint"))
        counted = long.groupBy("position").agg(distinct.alias("distinct_values"))
    else:
        counted = long.distinct().groupBy("position").agg(
            F.count(F.lit(1)).alias("distinct_values")
        )
    names = F.array(*[F.lit(f.name) for f in df.schema.fields])
    return counted.select(names[F.col("position")].alias("column"), "distinct_values")


def table_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Row counts of several tables in one job; file footers answer it for columnar tables."""
    counts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t).alias("table_name"), "rows")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def row_count_entry(
    df: DataFrame, table_name: str, as_of: datetime | str | None = None
) -> DataFrame:
    """The control row of one table: its name, its row count and the time of counting."""
    return df.agg(F.count(F.lit(1)).alias("table_count")).select(
        F.lit(table_name).alias("table_name"),
        "table_count",
        timestamp_literal(as_of).alias("count_timestamp"),
    )


def log_row_count(
    spark: SparkSession, table_name: str, target: str, as_of: datetime | str | None = None
) -> DataFrame:
    """Append the row count of a table to the control table; returns the logged entry."""
    counted = row_count_entry(spark.table(table_name), table_name, as_of)
    entry = spark.createDataFrame([counted.first()], counted.schema)
    append_by_position(entry, target)
    return entry


def latest_entries(control: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` latest control rows, newest first; ties go by table name and count."""
    return control.orderBy(
        F.col("count_timestamp").desc(), F.col("Table_name"), F.col("Table_count")
    ).limit(k)
