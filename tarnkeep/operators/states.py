"""Aggregates as mergeable states: kept per part of a table, and merged into results.

A state row is (part, kind, metric, bucket, value, data). Rows of one metric from any parts merge by their kind:

- ``sum`` and ``max``: of ``value``;
- ``keys``: distinct ``data``, one row per key and part;
- ``bits``: whole numbers as bitmaps of 32,768 numbers a bucket (``data``), for dense keys;
- ``sketch``: a HyperLogLog sketch (``data``), of fixed size whatever the number of keys.

So distinct counts are exact with keys and bits, and estimated with sketches; all are merged without the rows they came from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.names import named
from tarnkeep.operators.counts import distinct_text

PART_OF = "__part"
STATE = "part string, kind string, metric string, bucket bigint, value bigint, data binary"
SUM, MAX, KEYS, BITS, SKETCH = "sum", "max", "keys", "bits", "sketch"


def key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A text that two combinations of values share exactly when grouping treats them as equal."""
    return F.to_json(F.array(*[distinct_text(df.schema[c]) for c in columns]))


def _rows(part: Column, rows: Sequence[Column], df: DataFrame) -> DataFrame:
    return df.select(part.alias("part"), F.inline(F.array(*rows)))


def _row(kind: str, metric: str, value: Column | None = None, data: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(metric).alias("metric"), F.lit(None).cast("bigint").alias("bucket"),
        (F.lit(None) if value is None else value).cast("bigint").alias("value"),
        (F.lit(None) if data is None else data).cast("binary").alias("data"),
    )


def states(
    df: DataFrame,
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
    dense: Mapping[str, str] | None = None,
    sketches: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """State rows of each part of ``df``, named in its column ``__part``.

    ``sums`` and ``maxima`` are aggregates by metric; ``keys`` and ``sketches`` the columns of a metric whose
    distinct combinations count, null being a value; ``dense`` one whole-number column each.
    """
    sums, maxima, sketches = sums or {}, maxima or {}, sketches or {}
    part = F.col(PART_OF)
    parts = []
    wide, rows = [], []
    for kind, metrics in ((SUM, sums), (MAX, maxima)):
        for metric, measure in metrics.items():
            name = f"__s{len(wide)}"
            wide.append(measure.alias(name))
            rows.append(_row(kind, metric, F.col(name)))
    for metric, columns in sketches.items():
        name = f"__s{len(wide)}"
        wide.append(F.hll_sketch_agg(key_text(df, columns)).alias(name))
        rows.append(_row(SKETCH, metric, data=F.col(name)))
    for metric, column in (dense or {}).items():
        name = f"__s{len(wide)}"
        wide.append(F.max(named(column).isNull().cast("bigint")).alias(name))
        rows.append(_row(MAX, f"{metric}|null", F.col(name)))
    if wide:
        parts.append(_rows(F.col("part"), rows, df.groupBy(part.alias("part")).agg(*wide)))
    if keys:
        texts = [
            F.struct(F.lit(m).alias("metric"), key_text(df, c).cast("binary").alias("data")) for m, c in keys.items()
        ]
        found = df.select(part.alias("part"), F.inline(F.array(*texts))).distinct()
        parts.append(found.select(
            "part", F.lit(KEYS).alias("kind"), "metric", F.lit(None).cast("bigint").alias("bucket"),
            F.lit(None).cast("bigint").alias("value"), "data",
        ))
    if dense:
        bits = [
            F.struct(
                F.lit(m).alias("metric"), F.bitmap_bucket_number(named(c).cast("bigint")).alias("bucket"),
                F.bitmap_bit_position(named(c).cast("bigint")).alias("bit"),
            )
            for m, c in dense.items()
        ]
        places = df.select(part.alias("part"), F.inline(F.array(*bits))).filter("bit IS NOT NULL")
        parts.append(places.groupBy("part", "metric", "bucket").agg(
            F.bitmap_construct_agg("bit").alias("data")
        ).select(
            "part", F.lit(BITS).alias("kind"), "metric", "bucket", F.lit(None).cast("bigint").alias("value"), "data"
        ))
    return reduce(DataFrame.unionByName, parts)


def merged(rows: DataFrame) -> DataFrame:
    """(metric, value) of state rows of any parts."""
    def of(kind: str) -> DataFrame:
        return rows.filter(F.col("kind") == kind)

    counters = rows.filter(F.col("kind").isin(SUM, MAX)).groupBy("kind", "metric").agg(
        F.sum("value").alias("total"), F.max("value").alias("most")
    ).select("metric", F.when(F.col("kind") == SUM, F.col("total")).otherwise(F.col("most")).alias("value"))
    keys = of(KEYS).select("metric", "data").distinct().groupBy("metric").agg(F.count("*").alias("value"))
    bitmaps = of(BITS).groupBy("metric", "bucket").agg(F.bitmap_or_agg("data").alias("data"))
    bits = bitmaps.groupBy("metric").agg(F.sum(F.bitmap_count("data")).alias("value"))
    sketches = of(SKETCH).groupBy("metric").agg(F.hll_sketch_estimate(F.hll_union_agg("data")).alias("value"))
    return counters.unionByName(keys).unionByName(bits).unionByName(sketches)


def one_row(rows: DataFrame) -> DataFrame:
    """All merged values in one row: a map by metric, column ``m``. Metrics are as few as checks."""
    pairs = F.collect_list(F.struct("metric", "value"))
    return merged(rows).agg(F.map_from_entries(pairs).alias("m"))


def value_of(metric: str) -> Column:
    """A merged value out of :func:`one_row`, 0 if no part had any."""
    return F.coalesce(F.try_element_at("m", F.lit(metric)), F.lit(0))


def distinct_of(metric: str) -> Column:
    """A distinct count of any kind out of :func:`one_row`."""
    return value_of(metric) + value_of(f"{metric}|null")
