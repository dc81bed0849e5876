"""Shards by best-fit-decreasing bin packing of indivisible groups.

A group is all rows of one text. Groups go largest first, each into the shard with the least room that
still takes it; a balanced tree of (room, shard) finds that shard.

Groups of one size are alike, so the packing needs only how many there are of each size. These
classes are all that reaches the driver: d different sizes need at least d**2 / 2 bytes of text, so
100 TB have at most 14 million classes of two numbers each, and far fewer in practice. A shard
takes the next groups in order as long as they fit and no fuller shard could take one; such a run
is found by binary search in prefix sums, so the cost follows the number of runs. What comes back is one
(first rank, shard) per run, and a group finds its shard by its rank in the global order of sizes.

Two aims:

- :func:`fixed_capacity`: as few shards as best fit needs for a given capacity; a group beyond
  the capacity has a shard of its own;
- :func:`even`: a given number of shards with sizes near equal. The capacity is the smallest that
  a binary search finds to be enough. A group at or above the fair share of what is left can't be
  divided and has a shard of its own; the others share the rest.

A null text counts as empty (both are one group). Repeated rows belong to one group and have slots
of their own. Slots of a shard go by doc_id (nulls first), ties by the text's hash. An empty table
gives no row. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import materialize, prepare
from tarnkeep.llm.order import along, look_up

SHARDS = 8
LAW = "bytes"


# A balanced (AVL) tree of (room, shard) keys; a node is (key, left, right, height).

def _node(key, left, right):
    return key, left, right, 1 + max(left[3] if left else 0, right[3] if right else 0)


def _lean(tree) -> int:
    return (tree[1][3] if tree[1] else 0) - (tree[2][3] if tree[2] else 0)


def _turn_right(tree):
    key, left, right, _ = tree
    return _node(left[0], left[1], _node(key, left[2], right))


def _turn_left(tree):
    key, left, right, _ = tree
    return _node(right[0], _node(key, left, right[1]), right[2])


def _balanced(key, left, right):
    tree = _node(key, left, right)
    if _lean(tree) > 1:
        return _turn_right(_node(key, _turn_left(left), right) if _lean(left) < 0 else tree)
    if _lean(tree) < -1:
        return _turn_left(_node(key, left, _turn_right(right)) if _lean(right) > 0 else tree)
    return tree


def insert(tree, key):
    if tree is None:
        return _node(key, None, None)
    if key < tree[0]:
        return _balanced(tree[0], insert(tree[1], key), tree[2])
    return _balanced(tree[0], tree[1], insert(tree[2], key))


def remove(tree, key):
    at, left, right, _ = tree
    if key < at:
        return _balanced(at, remove(left, key), right)
    if key > at:
        return _balanced(at, left, remove(right, key))
    if left is None or right is None:
        return left or right
    least = right
    while least[1]:
        least = least[1]
    return _balanced(least[0], left, remove(right, least[0]))


def around(tree, room: int):
    """(the key with the largest room below ``room``, the key with the smallest from it on)."""
    below = above = None
    while tree:
        if tree[0][0] < room:
            below, tree = tree[0], tree[2]
        else:
            above, tree = tree[0], tree[1]
    return below, above


def best_fit(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, most: int | None = None
) -> tuple[list[tuple[int, int]], int] | None:
    """Runs (first rank, shard) and the number of shards, for classes in descending order of size.

    With ``most``, all shards are open from the start, and None tells that they don't suffice. Without, a new one is
    opened when no other takes the next group.
    """
    total = np.concatenate([[0], np.cumsum(sizes * counts)])
    ranks = np.concatenate([[0], np.cumsum(counts)])
    tree = None
    for shard in range(most or 0):
        tree = insert(tree, (capacity, shard))
    opened = most or 0
    runs: list[tuple[int, int]] = []
    i = used = 0  # the class at hand, and how many of its groups are placed
    while i < len(sizes):
        size = int(sizes[i])
        fuller, fit = around(tree, size)
        if fit is None:
            if most is not None:
                return None
            fit = (max(capacity, size), opened)
            tree = insert(tree, fit)
            opened += 1
        room, shard = fit
        # classes before `stop` are too large for every fuller shard
        stop = len(sizes) if fuller is None else int(np.searchsorted(-sizes, -fuller[0]))
        # whole classes first, then as much of the next one as still fits
        start = int(total[i]) + used * size
        end = min(stop, int(np.searchsorted(total, start + room, side="right")) - 1)
        if not runs or runs[-1][1] != shard:
            runs.append((int(ranks[i]) + used, shard))
        taken = 0
        if end > i:
            taken, i, used = int(total[end]) - start, end, 0
        if i < stop:
            k = min(int(counts[i]) - used, (room - taken) // int(sizes[i]))
            taken, used = taken + k * int(sizes[i]), used + k
            if used == counts[i]:
                i, used = i + 1, 0
        tree = insert(remove(tree, fit), (room - taken, shard))
    return runs, opened


def even_runs(sizes: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple[int, int]]:
    """Runs (first rank, shard) of ``shards`` shards with sizes near equal."""
    sizes, counts = sizes.copy(), counts.copy()
    left, taken, runs = int((sizes * counts).sum()), 0, []
    while len(sizes) and taken < shards - 1 and int(sizes[0]) * (shards - taken) >= left:
        runs.append((taken, taken))
        left -= int(sizes[0])
        taken += 1
        counts[0] -= 1
        if not counts[0]:
            sizes, counts = sizes[1:], counts[1:]
    if not len(sizes):
        return runs
    fair = -(-left // (shards - taken))
    low, high = max(fair, int(sizes[0])), fair + int(sizes[0])  # `high` is always enough
    while low < high:
        middle = (low + high) // 2
        if best_fit(sizes, counts, middle, shards - taken) is None:
            low = middle + 1
        else:
            high = middle
    found = best_fit(sizes, counts, high, shards - taken)
    return runs + [(rank + taken, shard + taken) for rank, shard in found[0]]


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and h, the SHA-256 of the text; texts are read here only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("h"),
        F.monotonically_increasing_id().alias("r"),
    )


def _placed(rows: DataFrame, choose) -> DataFrame:
    """``rows`` with their group's shard; ``choose`` maps size classes to runs."""
    groups = materialize(
        rows.groupBy("h").agg(F.count("*").alias("n"), F.max("size").alias("size"))
        .withColumn("weight", F.col("n") * F.col("size")).drop("size")
    )
    ranked = along(groups, [], [F.desc("weight"), "h"])
    classes = groups.groupBy("weight").agg(
        F.count("*").alias("groups"), F.sum("n").alias("rows")
    ).toPandas().sort_values("weight", ascending=False)
    if not len(classes):
        return rows.withColumn("shard", F.lit(0))
    runs = choose(classes["weight"].to_numpy(np.int64), classes["groups"].to_numpy(np.int64))
    starts = np.array([r for r, _ in runs], dtype=np.int64)
    shards = np.array([s for _, s in runs], dtype=np.int32)

    @F.pandas_udf("int")
    def shard_of(rank: pd.Series) -> pd.Series:
        return pd.Series(shards[np.searchsorted(starts, rank.to_numpy(), side="right") - 1])

    found = ranked.select("h", "n", shard_of("at").alias("shard"))
    return look_up(rows, found, ["h"], "n", int(classes["rows"].sum()))


def _slotted(docs: DataFrame, choose) -> DataFrame:
    prepare(docs.sparkSession)
    placed = materialize(_placed(materialize(rows_of(docs)), choose))
    return along(placed, ["shard"], [F.asc_nulls_first("doc_id"), "h", "r"]).select(
        "doc_id", "size", "text_crc32", "shard", F.col("at").alias("slot")
    )


def even(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Each row's size, text_crc32, shard (0 to ``shards`` - 1) and slot, shards near equal in size."""
    return _slotted(docs, lambda sizes, counts: even_runs(sizes, counts, shards))


def fixed_capacity(docs: DataFrame, capacity: int) -> DataFrame:
    """As :func:`even`, in as few shards of ``capacity`` as best fit needs."""
    return _slotted(docs, lambda sizes, counts: best_fit(sizes, counts, capacity)[0])


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """The documents, all columns, as folders ``shard=<n>`` of Parquet files below ``path``.

    Equal texts share a folder. It is ``_shard=<n>`` if the documents have a column ``shard``.
    """
    prepare(docs.sparkSession)
    folder = "shard"
    while folder in docs.columns:
        folder = f"_{folder}"
    key = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    rows = materialize(rows_of(docs))
    groups = _placed(rows, lambda s, c: even_runs(s, c, shards)).groupBy("h").agg(
        F.count("*").alias("n"), F.max("shard").alias("shard")
    )
    own = docs.select(F.struct("*").alias("row"), key.alias("h"))
    out = look_up(own, materialize(groups), ["h"], "n", rows.count())
    out = out.select(F.col("shard").alias(folder), "row.*")
    out.write.mode("errorifexists").partitionBy(folder).parquet(path)
    return docs.sparkSession.read.parquet(path)


def report(docs: DataFrame) -> DataFrame:
    return even(docs).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
