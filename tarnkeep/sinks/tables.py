"""Sinks: tables by path and by name, positional appends, table creation and the report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.contracts import Contract, date_literal


def write_path(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a table at ``path``; overwriting also replaces its schema."""
    writer = df.write.format(fmt).mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Write a named table; overwriting also replaces its schema.

    Bucketing by the key lets later joins and aggregations on that key skip the shuffle of this
    table.
    """
    writer = df.write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if fmt:
        writer = writer.format(fmt)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def append_by_position(df: DataFrame, name: str) -> None:
    """Append columns by position, cast to the types of the target table."""
    df.write.mode("append").insertInto(name)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def ensure_table(
    spark: SparkSession, name: str, contract: Contract, fmt: str = "parquet"
) -> None:
    """Create the table of a contract unless it is already there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl}) USING {fmt}")


def write_report(
    report: DataFrame, target: str, run_date: date | str | None = None, fmt: str = "json"
) -> None:
    """Write a check report to the folders of its run date and tables.

    A repeated date replaces the report of the tables it holds; those of other tables stay.
    """
    dated = report.withColumn("run_date", date_literal(run_date))
    dated.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_date", "table"
    ).save(target)


def close_current(
    changed_keys: DataFrame, table: str, keys: Sequence[str], as_of: date | str | None = None
) -> None:
    """Close the current history rows of ``changed_keys`` in place with one MERGE.

    Needs a catalog with row-level updates; plain file tables have none and refuse it.
    """
    match = " AND ".join(f"{table}.{k} <=> __changed.{k}" for k in keys)
    (
        changed_keys.select(*keys).distinct().alias("__changed")
        .mergeInto(table, F.expr(f"{match} AND {table}.current_flag"))
        .whenMatched()
        .update({"current_flag": F.lit(False), "effective_end_date": date_literal(as_of)})
        .merge()
    )
