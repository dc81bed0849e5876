"""Prefix trie of conversations, its subtrees summed up along an Euler tour.

A node is a distinct sequence of first turns (role, text); it is found by a grouping over running hashes of
the turns, two of 62 bits, so no step holds a conversation or a subtree. Where a conversation has
members in a node's subtree, the smallest one names it: (conv_id, depth) is a node's id.

Tour. Each node has an enter and an exit arc; siblings go by conv_id. The arc before an enter arc is the
exit of the previous sibling, or the parent's enter; before an exit arc it is the exit of the last child,
or the node's own enter. Previous siblings come from a sort over ranges (:func:`order.along`).

List ranking, distributed, in two steps:

1. Nodes are dealt by ranges of (conv_id, depth). Each task links the arcs whose predecessor it
   holds into fragments, by pointer doubling over arrays, and sums ranks and weights within them.
   Conversations close in number share most of the tour, so few fragments are left; whatever the
   order of the numbers, the result is the same.
2. Fragments are ranked by pointer doubling over joins, with a written table after each round,
   until all lead to the root's; a list of n fragments takes log2(n) rounds.

A subtree's leaves and savings are the prefix sum at its exit arc less that before its enter arc.

Nulls: rows without a conv_id are left out (there is no conversation to rebuild); a null role or
text counts as empty; null turns come first; rows of one turn go by the hash of role and text. Repeated rows
are turns of their own. An empty table gives no node. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import materialize, part_count, prepare
from tarnkeep.llm.order import MODULUS, along, look_up

#: The stated rebuilding: families of conversations, and how many first turns they can share.
FAMILY = 100
SHARED = 6
#: Bytes of a block of conv_ids on its way to a digest.
BLOCK = 1 << 16
_NODE = ("d", "k1", "k2")


def _masked(hashed: Column) -> Column:
    return hashed.bitwiseAND(MODULUS - 1)


def numbered(conversations: DataFrame) -> DataFrame:
    """c, at (0 for the first turn), t1, t2 (hashes of role and text) and chars (of the text)."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("r"),
    )
    placed = along(rows, ["c"], [F.asc_nulls_first("turn"), "t1", "t2", "r"])
    return placed.select("c", "at", "t1", "t2", "chars")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): c, d (1 for the first turn), t1, t2, chars; and all c.

    Conversation c has the first h turns of conversation c - c % 100, then its own after its first
    h; h is the crc32 of c as text, modulo 6.
    """
    turns = numbered(conversations)
    h = (F.crc32(F.col("c").cast("string")) % SHARED).alias("h")
    heads = turns.filter((F.col("at") < SHARED - 1) & (F.col("c") % FAMILY == 0)).groupBy("c").agg(
        F.array_sort(F.collect_list(F.struct("at", "t1", "t2", "chars"))).alias("head")
    )
    sizes = turns.groupBy("c").agg(F.count("*").alias("n"))
    convs = materialize(
        sizes.join(heads.select(F.col("c").alias("b"), "head"), F.expr(f"c - c % {FAMILY}") == F.col("b"), "left")
        .select("c", "n", F.coalesce(F.slice("head", 1, h.cast("int")), F.array()).alias("head"))
        .withColumn("m", F.size("head"))
    )
    total = convs.agg(F.sum("n")).first()[0] or 0
    shared = convs.select("c", F.inline("head")).select("c", (F.col("at") + 1).alias("d"), "t1", "t2", "chars")
    own = look_up(turns.filter(F.col("at") >= h), convs.select("c", "n", "m"), ["c"], "n", total)
    own = own.select("c", (F.col("m") + F.col("at") - h + 1).alias("d"), "t1", "t2", "chars")
    return shared.unionByName(own), convs.select("c")


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids in column c, ascending and comma-joined.

    Ids are joined into blocks where they are sorted, so a node that many conversations end at
    costs the digest's task few rows.
    """
    spark = ends.sparkSession
    parts = part_count(spark)
    key = "d long, k1 long, k2 long"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        node, held, size, number, out = None, [], 0, 0, []
        for frame in batches:
            for *own, c in zip(*(frame[x].tolist() for x in (*_NODE, "c")), strict=True):
                if own != node or size >= BLOCK:
                    if held:
                        out.append((*node, part, number, ",".join(held)))
                        number += 1
                    node, held, size = own, [], 0
                text = str(c)
                held.append(text)
                size += len(text) + 1
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=[*_NODE, "part", "number", "block"])
                out = []
        if held:
            out.append((*node, part, number, ",".join(held)))
        if out:
            yield pd.DataFrame(out, columns=[*_NODE, "part", "number", "block"])

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest, out = None, None, []
        for frame in frames:
            for *own, block in zip(*(frame[x].tolist() for x in (*_NODE, "block")), strict=True):
                if own == node:
                    digest.update(b",")
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                digest.update(block.encode())
            if out:
                yield pd.DataFrame(out, columns=[*_NODE, "ends"])
                out = []
        if node:
            yield pd.DataFrame([(*node, digest.hexdigest())], columns=[*_NODE, "ends"])

    order = [*_NODE, "c"]
    joined = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(
        blocks, f"{key}, part int, number int, block string"
    )
    dealt = joined.repartition(parts, *_NODE).sortWithinPartitions(*_NODE, "part", "number")
    return dealt.mapInPandas(digests, f"{key}, ends string")


def _nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes with their id (c, d), parent's conv p, previous sibling s, last child z, and counts."""
    hashed = materialize(turns.select("c", "d", "chars", *(
        _masked(F.xxhash64(F.lit(i), "d", "t1", "t2")).alias(f"h{i}") for i in (1, 2)
    )))
    rows = along(hashed, ["c"], ["d"], ["h1", "h2"]).withColumnsRenamed({"run_h1": "k1", "run_h2": "k2"})
    rows = rows.select("c", *_NODE, "chars", *(
        _masked(F.col(f"k{i}") - F.col(f"h{i}") + MODULUS).alias(f"p{i}") for i in (1, 2)
    ))
    below = rows.groupBy(*_NODE).agg(
        F.min("c").alias("c"), F.count("*").alias("n"), F.max("chars").alias("chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("c").alias("c"), F.count("*").alias("n")).filter("n > 0").select(
        *(zero.alias(x) for x in _NODE), "c", "n", zero.alias("chars"), none.alias("p1"), none.alias("p2")
    )
    nodes = materialize(below.unionByName(root))

    last = rows.groupBy("c").agg(F.max(F.struct(*_NODE)).alias("e"))
    ends = materialize(convs.join(last, "c", "left").select(
        "c", *(F.coalesce(F.col("e")[x], zero).alias(x) for x in _NODE)
    ))
    children = nodes.filter("d > 0").groupBy(
        (F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("kids"), F.min("c").alias("a"), F.max("c").alias("z"))
    known = materialize(
        nodes.join(children, list(_NODE), "left").join(_digests(ends), list(_NODE), "left").select(
            "c", *_NODE, "p1", "p2", "n", F.coalesce("kids", zero).alias("kids"), "a", "z",
            ((F.col("n") - 1) * F.col("chars")).alias("own"),
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"),
        )
    )
    # every child learns its parent's conv and first child
    parents = known.filter("kids > 0").select(
        (F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("c").alias("p"), F.col("a").alias("first"), "kids",
    )
    kept = ("c", "d", "n", "kids", "z", "own", "ends")
    taught = materialize(look_up(
        known.filter("d > 0").select(*kept, "p1", "p2"), parents.withColumnRenamed("kids", "size"),
        ["d", "p1", "p2"], "size", known.count(),
    ).select(*kept, "p", "first"))
    # a child named like its parent comes first; only the others need a search for their sibling
    others = along(taught.filter("c != p"), ["p", "d"], ["c"], lags=["c"])
    sibling = F.when(F.col("c") != F.col("first"), F.coalesce("last_c", "first"))
    return (
        others.select(*kept, "p", sibling.alias("s"))
        .unionByName(taught.filter("c = p").select(*kept, "p", none.alias("s")))
        .unionByName(known.filter("d = 0").select(*kept, none.alias("p"), none.alias("s")))
    )


_SUMS = ("rank", "leaves", "saved")
_FRAGMENTS = ", ".join(
    f"{side}_c long, {side}_a long, {side}_qc long, {side}_qa long, "
    + ", ".join(f"{side}_{s} long" for s in _SUMS)
    for side in ("e", "x")
)


def _arcs(frame: pd.DataFrame) -> pd.DataFrame:
    """The fragments of the arcs of a range of nodes, sorted by (c, d).

    Arc 2 * d of conversation c enters its node, arc 2 * d + 1 leaves it. For each arc: its
    fragment, named by the first arc, ``q`` the arc before that one if this is it, and the sums from
    the fragment's start.
    """
    n = len(frame)
    c, d = frame["c"].to_numpy(), frame["d"].to_numpy()
    at_c, at_a = np.repeat(c, 2), np.repeat(2 * d, 2)
    at_a[1::2] += 1
    parent, sibling, last = (frame[x] for x in ("p", "s", "z"))
    up, side, down = parent.notna().to_numpy(), sibling.notna().to_numpy(), last.notna().to_numpy()
    before_c, before_a = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64)
    whole = lambda x: x.fillna(0).to_numpy(np.int64)
    before_c[::2] = np.where(side, whole(sibling), whole(parent))
    before_a[::2] = np.where(side, 2 * d + 1, 2 * (d - 1))
    before_c[1::2] = np.where(down, whole(last), c)
    before_a[1::2] = np.where(down, 2 * (d + 1) + 1, 2 * d)
    linked = np.ones(2 * n, dtype=bool)
    linked[::2] = up

    # nodes of one conversation are neighbours with depths in a row
    starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    sizes = np.diff(np.append(starts, n))
    group = np.clip(np.searchsorted(c[starts], before_c), 0, len(starts) - 1)
    step = before_a // 2 - d[starts][group]
    here = linked & (c[starts][group] == before_c) & (step >= 0) & (step < sizes[group])
    to = np.where(here, 2 * (starts[group] + step) + before_a % 2, -1)

    first = np.arange(2 * n)
    rank = here.astype(np.int64)
    leaves, saved = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
    leaves[::2] = frame["kids"].to_numpy() == 0
    saved[::2] = frame["own"].to_numpy()
    pointer = to.copy()
    while True:
        on = np.flatnonzero(pointer >= 0)
        if not len(on):
            break
        by = pointer[on]
        for value in (rank, leaves, saved):
            value[on] += value[by]
        first[on], pointer[on] = first[by], pointer[by]

    open_end = linked & ~here
    out = frame[["c", "d", "p", "n", "kids", "own", "ends"]].copy()
    for side, i in (("e", 0), ("x", 1)):
        out[f"{side}_c"], out[f"{side}_a"] = at_c[first][i::2], at_a[first][i::2]
        for name, value in (("qc", before_c), ("qa", before_a)):
            out[f"{side}_{name}"] = pd.Series(value[i::2]).where(pd.Series(open_end[i::2])).astype("Int64")
        for name, value in zip(_SUMS, (rank, leaves, saved), strict=True):
            out[f"{side}_{name}"] = value[i::2]
    return out


def _contracted(nodes: DataFrame) -> DataFrame:
    """Nodes with the fragments of their arcs, one range of (c, d) per task."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [f.astype({x: "Int64" for x in ("p", "s", "z")}) for f in frames if len(f)]
        if whole:
            made = _arcs(pd.concat(whole, ignore_index=True))
            for at in range(0, len(made), 20_000):
                yield made.iloc[at : at + 20_000]

    dealt = nodes.repartitionByRange(part_count(nodes.sparkSession), "c", "d").sortWithinPartitions("c", "d")
    schema = "c long, d long, p long, n long, kids long, own long, ends string, " + _FRAGMENTS
    return dealt.mapInPandas(link, schema)


def _ranked(table: DataFrame) -> DataFrame:
    """The sums before each fragment (fc, fa), by pointer doubling from fragment to fragment."""
    sides = F.array(*(
        F.struct(
            F.col(f"{s}_c").alias("fc"), F.col(f"{s}_a").alias("fa"), F.col(f"{s}_qc").alias("qc"),
            F.col(f"{s}_qa").alias("qa"), ((F.col(f"{s}_c") == F.col("c")) & (F.col(f"{s}_a") == a)).alias("own"),
        )
        for s, a in (("e", F.col("d") * 2), ("x", F.col("d") * 2 + 1))
    ))
    fragments = materialize(
        table.select(F.inline(sides)).filter(F.col("own")).drop("own")
    )
    leaving = F.col("qa") % 2 == 1
    pick = lambda x: F.when(leaving, F.col(f"x_{x}")).otherwise(F.col(f"e_{x}"))
    ends = table.select(
        F.col("c").alias("qc"), F.col("d").alias("qd"),
        *(F.col(f"{s}_{x}") for s in ("e", "x") for x in ("c", "a", *_SUMS)),
    )
    joined = fragments.filter("qc IS NOT NULL").withColumn("qd", F.expr("qa div 2")).join(ends, ["qc", "qd"])
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    state = materialize(
        joined.select(
            "fc", "fa", pick("c").alias("gc"), pick("a").alias("ga"),
            # the fragment's first arc is one step behind the arc before it
            (pick("rank") + 1).alias("rank"), pick("leaves").alias("leaves"), pick("saved").alias("saved"),
        ).unionByName(fragments.filter("qc IS NULL").select(
            "fc", "fa", none.alias("gc"), none.alias("ga"), *(zero.alias(s) for s in _SUMS)
        ))
    )
    while not state.filter("gc IS NOT NULL").isEmpty():
        target = state.select(
            F.col("fc").alias("gc"), F.col("fa").alias("ga"), F.col("gc").alias("nc"), F.col("ga").alias("na"),
            *(F.col(s).alias(f"more_{s}") for s in _SUMS),
        )
        on = state.filter("gc IS NOT NULL").join(target, ["gc", "ga"]).select(
            "fc", "fa", F.col("nc").alias("gc"), F.col("na").alias("ga"),
            *((F.col(s) + F.col(f"more_{s}")).alias(s) for s in _SUMS),
        )
        state = materialize(on.unionByName(state.filter("gc IS NULL")))
    return state.drop("gc", "ga")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the sequences in ``turns`` (c, d from 1 without gaps, t1, t2, chars).

    ``convs`` has every c once, also those without turns. A node has conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the places of its
    arcs in the tour, enter_at and exit_at.
    """
    table = materialize(_contracted(materialize(_nodes(turns, convs))))
    sums = _ranked(table)
    out = table
    for side in ("e", "x"):
        base = sums.select(
            F.col("fc").alias(f"{side}_c"), F.col("fa").alias(f"{side}_a"),
            *(F.col(s).alias(f"{side}_base_{s}") for s in _SUMS),
        )
        out = out.join(base, [f"{side}_c", f"{side}_a"])

    def upto(side: str, name: str) -> Column:
        return F.col(f"{side}_base_{name}") + F.col(f"{side}_{name}")

    return out.select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("p").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        # sums hold the arc's own value: that of the enter arc belongs to the subtree
        (upto("x", "leaves") - upto("e", "leaves") + (F.col("kids") == 0).cast("long")).alias("n_leaves"),
        (upto("x", "saved") - upto("e", "saved") + F.col("own")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"), upto("e", "rank").alias("enter_at"), upto("x", "rank").alias("exit_at"),
    )


def report(conversations: DataFrame) -> DataFrame:
    prepare(conversations.sparkSession)
    return trie(*rebuilt(conversations))
