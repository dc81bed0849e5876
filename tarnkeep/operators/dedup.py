"""Duplicates: exact ones, and one surviving row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.session import materialize

#: Hashes of repeated rows that are sent to every task, at most.
REPEATED = 500_000


def _orderable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep the first row of each key in a stated order.

    Without ``order_by`` the remaining columns order the rows, so the survivor does not depend on
    how the data happens to be partitioned. Spark limits each key to one row per map task before
    the shuffle, so a key with a third of all rows still sends only a handful of them.
    """
    if order_by is None:
        order_by = [
            f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)
        ]
    order = list(order_by) or [F.lit(0)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_mostly(df: DataFrame) -> DataFrame:
    """As :func:`distinct_rows`, for a written table few of whose rows are copies; the table is read at once.

    Only the rows' hashes are shuffled. A row whose hash occurs once has no copy and stays where it is; those
    whose hash occurs again, copies or not, are compared whole. With more than ``REPEATED`` such hashes all rows are.
    """
    if not all(_orderable(f.dataType) for f in df.schema.fields):
        return distinct_rows(df)
    marked = df.withColumn("__hash", F.xxhash64(*df.columns))
    counts = marked.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"))
    repeated = materialize(counts.filter("__n > 1").select("__hash", F.lit(True).alias("__again")))
    if repeated.count() > REPEATED:
        return distinct_rows(df)
    marked = marked.join(F.broadcast(repeated), "__hash", "left")
    alone = marked.filter("__again IS NULL").select(*df.columns)
    return alone.unionByName(distinct_rows(marked.filter("__again").select(*df.columns)))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """One row: how many rows are copies of another row."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))
