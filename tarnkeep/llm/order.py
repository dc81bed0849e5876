"""Numbers, running sums and predecessors along a global order, with no group in one task.

Rows are dealt by ranges of (groups, order) and sorted there, so a group of any size spreads over
tasks. Each task numbers its own rows; what a group has gathered in earlier ranges is one row per
range, added to the first group of the next. Rows that agree in all sort columns share a range:
add a unique column where there may be many of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import materialize, part_count

#: Running sums are kept modulo this, so that they neither overflow here nor in Spark's arithmetic.
MODULUS = 1 << 62
_OWN = ("__part", "__row", "__first")


def _along(batches: Iterator[pa.RecordBatch], groups, sums, lags) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    mask = np.uint64(MODULUS - 1)
    row, first = 0, True
    last_group, count, totals = None, 0, [np.uint64(0)] * len(sums)
    before: list = [None] * len(lags)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = [batch.column(g).to_numpy() for g in groups]
        new = np.zeros(n, dtype=bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        fresh = last_group is not None and any(
            k[0] != v for k, v in zip(keys, last_group, strict=True)
        )
        new[0] = fresh
        places = np.arange(n)
        start = np.maximum.accumulate(np.where(new, places, -1))  # -1: the group goes on
        at = places - np.maximum(start, 0) + np.where(start < 0, count, 0)
        runs = []
        for i, name in enumerate(sums):
            value = batch.column(name).to_numpy().astype(np.int64).view(np.uint64)
            upto = np.cumsum(value, dtype=np.uint64)
            base = np.where(start < 0, totals[i], np.uint64(0) - (upto - value)[np.maximum(start, 0)])
            run = (upto + base) & mask
            runs.append(run)
            totals[i] = run[-1]
        previous = []
        for i, name in enumerate(lags):
            value = batch.column(name).to_numpy(zero_copy_only=False)
            shifted = np.concatenate([[0 if before[i] is None else before[i]], value[:-1]])
            known = ~new
            known[0] &= before[i] is not None
            previous.append(pa.array(shifted.astype(np.int64), mask=~known))
            before[i] = value[-1]
        first_rows = first & (start < 0)
        first = bool(first_rows[-1])
        columns = [
            pa.array(np.full(n, part, dtype=np.int32)), pa.array(row + places),
            pa.array(np.broadcast_to(first_rows, n)), pa.array(at.astype(np.int64)),
            *(pa.array(r.astype(np.int64)) for r in runs), *previous,
        ]
        names = [
            *_OWN, "at", *(f"run_{s}" for s in sums), *(f"last_{x}" for x in lags),
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *columns], names=[*batch.schema.names, *names]
        )
        last_group = [k[-1] for k in keys]
        count, row = int(at[-1]) + 1, row + n


def along(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str | Column],
    sums: Sequence[str] = (),
    lags: Sequence[str] = (),
) -> DataFrame:
    """``df`` with ``at``, its place from 0 in its group, and more along the same order.

    ``run_<s>`` is the running sum of a column, its own value included, modulo 2**62;
    ``last_<x>`` the value one row earlier in the group (null for the first). ``groups``, ``sums`` and
    ``lags`` are whole-number columns without nulls. The table is sampled for its ranges, so
    what is costly to compute should be written before.
    """
    spark = df.sparkSession
    by = [*groups, *order]
    extra = [
        "__part int", "__row long", "__first boolean", "at long",
        *(f"run_{s} long" for s in sums), *(f"last_{x} long" for x in lags),
    ]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + extra)
    dealt = df.repartitionByRange(part_count(spark), *by).sortWithinPartitions(*by)
    names = (list(groups), list(sums), list(lags))
    table = materialize(dealt.mapInArrow(lambda batches: _along(batches, *names), schema))

    # one row per range
    ends = [*groups, "at", *(f"run_{s}" for s in sums), *lags]
    ranges = table.groupBy("__part").agg(
        F.bool_and("__first").alias("single"),
        F.min_by(F.struct(F.lit(0).alias("z"), *groups), "__row").alias("head"),
        F.max_by(F.struct(*ends), "__row").alias("end"),
    ).collect()
    carried, last = [], None
    for r in sorted(ranges, key=lambda r: r["__part"]):
        goes_on = last is not None and all(r.head[g] == last[g] for g in groups)
        held = [0] * (1 + len(sums))
        if goes_on:
            held = [last["at"] + 1, *(last[f"run_{s}"] for s in sums)]
            carried.append((r["__part"], *held, *(last[x] for x in lags)))
        last = r.end.asDict()
        if goes_on and r.single:
            last["at"] += held[0]
            for s, h in zip(sums, held[1:], strict=True):
                last[f"run_{s}"] = (last[f"run_{s}"] + h) % MODULUS
    fields = ", ".join(
        ["__part int", "c_at long", *(f"c_{s} long" for s in sums), *(f"c_last_{x} long" for x in lags)]
    )
    # at most one row per range: small, whatever the table's size
    carry = F.broadcast(spark.createDataFrame(carried, fields))

    def plus(name: str, more: str) -> Column:
        return F.col(name) + F.when(F.col("__first"), F.coalesce(more, F.lit(0))).otherwise(0)

    out = table.join(carry, "__part", "left")
    return out.select(
        *df.columns,
        plus("at", "c_at").alias("at"),
        *(plus(f"run_{s}", f"c_{s}").bitwiseAND(MODULUS - 1).alias(f"run_{s}") for s in sums),
        *(
            F.when(F.col("__row") == 0, F.col(f"c_last_{x}")).otherwise(F.col(f"last_{x}"))
            .alias(f"last_{x}") for x in lags
        ),
    )


def look_up(rows: DataFrame, found: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with the one row of ``found`` that has their keys, whatever the skew.

    ``size`` tells how many rows each key has and is dropped. Keys with a share of 1 / partitions of ``total``
    or more are at most as many as there are partitions, and are broadcast; all others are joined
    by a shuffle, in which no key exceeds that share. Keys are not null.
    """
    bar = max(1, total // part_count(rows.sparkSession))
    hot = F.broadcast(found.filter(F.col(size) > bar).drop(size))
    rest = found.filter(F.col(size) <= bar).drop(size)
    cold = rows.join(hot.select(*keys), list(keys), "left_anti").join(rest, list(keys))
    return rows.join(hot, list(keys)).unionByName(cold)
