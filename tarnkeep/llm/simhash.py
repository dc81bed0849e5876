"""SimHash near-duplicates: fingerprints, their links by a binary trie self-join, and components.

Documents with one fingerprint are one class; links are looked for between classes only. Two
fingerprints with ``budget`` differing bits or fewer agree in at least one of ``budget + 1`` blocks
of bits. So each class goes to one trie for each block, in which that block's bits come first, and
tries are dealt out by the block's value: a task walks whole subtrees. The walk takes pairs of nodes
level by level, adds up the bits in which they differ, and drops a pair whose sum exceeds the
budget. A subtree with many classes costs the pairs of nodes within the budget, not all pairs, and
yields one row for each class (its smallest linked class there), never the pairs themselves.

Components follow from these rows by large-star and small-star rounds until nothing changes.

Texts without words (null, empty, white space) have fingerprint zero and are linked like any other.
Repeated rows have equal fingerprints and fall in one class. A null doc_id never is a component's
id unless all are null. An empty table gives an empty result. Columns other than doc_id and text
are not looked at.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, materialize, part_count, per_text

BITS = 64
BUDGET = 2
WORDS = 3
_hash = partial(xxhash.xxh64_intdigest, seed=42)
#: Node pairs that a walk handles at once.
FRONT = 1 << 18


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """One bit for each of 64 places: set where over half the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        return _hash(b" ".join(words))
    n = len(words) - size + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter(map(_hash, shingles), np.uint64, n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * c > n else "0" for c in ones), 2)


def _key() -> list[Column]:
    """What names a row: its doc_id as text (null: empty) and a hash of its text."""
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
        F.xxhash64("text").alias("__h"),
    ]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, the row's key, and ``fp``, the fingerprint as a signed long."""

    def make():
        def of(texts):
            fps = np.array([fingerprint(t) for t in as_bytes(texts)], dtype=np.uint64)
            return pd.DataFrame({"fp": fps.view(np.int64)})

        return of

    docs = doc_columns(docs)
    return docs.select(
        "doc_id", *_key(), per_text(make, "fp long", "text")["fp"].alias("fp")
    )


# ---- the trie ----


def turned(fps: np.ndarray, block: int, blocks: int) -> np.ndarray:
    """Unsigned fingerprints with a block's bits moved to the front."""
    left = np.uint64(block * BITS // blocks)
    if not left:
        return fps
    return (fps << left) | (fps >> np.uint64(BITS - int(left)))


def block_bits(block: int, blocks: int) -> int:
    return (block + 1) * BITS // blocks - block * BITS // blocks


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def linked(keys: np.ndarray, depth: int, budget: int = BUDGET) -> np.ndarray:
    """For each of the sorted distinct ``keys``, the smallest place reachable by links.

    A link joins keys that agree in their first ``depth`` bits and differ in ``budget`` or fewer.
    """
    parent = np.arange(len(keys))
    if len(keys) < 2:
        return parent
    head = keys >> np.uint64(BITS - depth) if depth else np.zeros_like(keys)
    cut = np.flatnonzero(np.diff(head)) + 1
    lo, hi = np.append(0, cut), np.append(cut, len(keys))
    big = hi - lo > 1
    lo, hi = lo[big], hi[big]
    # a node is a range of keys; a pair is two nodes at one depth and the bits in which they differ
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int64))]
    while stack:
        level, a, b, c, d, differ = stack.pop()
        if len(a) > FRONT:
            half = len(a) // 2
            stack.append((level, *(x[half:] for x in (a, b, c, d, differ))))
            stack.append((level, *(x[:half] for x in (a, b, c, d, differ))))
            continue
        # two single keys: the rest of their bits at once
        single = (b - a == 1) & (d - c == 1)
        if single.any():
            x, y = a[single], c[single]
            near = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            for i, j in zip(x[near].tolist(), y[near].tolist(), strict=True):
                i, j = _find(parent, i), _find(parent, j)
                if i != j:
                    parent[max(i, j)] = min(i, j)
            a, b, c, d, differ = (x[~single] for x in (a, b, c, d, differ))
        if not len(a) or level == BITS:
            continue
        bit = np.uint64(BITS - 1 - level)
        pairs = []
        ma, mc = _middle(keys, a, b, bit), _middle(keys, c, d, bit)
        same = a == c
        for (x, y), (z, w), more in (
            ((a, ma), (c, mc), 0), ((ma, b), (mc, d), 0),
            ((a, ma), (mc, d), 1), ((ma, b), (c, mc), 1),
        ):
            keep = (x < y) & (z < w) & (differ + more <= budget)
            if more and y is b:
                keep &= ~same  # the mirror of the pair before
            # a node with itself holds no pair if it is a single key
            keep &= ~(same & (more == 0) & (y - x == 1))
            if keep.any():
                pairs.append((x[keep], y[keep], z[keep], w[keep], differ[keep] + more))
        if pairs:
            stack.append((level + 1, *map(np.concatenate, zip(*pairs, strict=True))))
    return np.array([_find(parent, i) for i in range(len(keys))])


def _middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """The first place of each range whose key has the bit set; keys agree before the bit."""
    top = (keys[lo] >> bit) | np.uint64(1)
    at = np.searchsorted(keys, top << bit)
    return np.clip(at, lo, hi)


def links(classes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b): each class and a smaller place linked to it, from the column ``fp``.

    Nothing is left out: classes linked within one subtree are chained to its smallest.
    """
    blocks = budget + 1
    copies = classes.select("fp", F.explode(F.array(*[F.lit(i) for i in range(blocks)])).alias("t"))
    heads = [
        F.shiftrightunsigned(
            F.shiftleft("fp", i * BITS // blocks), BITS - block_bits(i, blocks)
        )
        for i in range(blocks)
    ]
    head = reduce(lambda a, i: F.when(F.col("t") == i, heads[i]).otherwise(a), range(blocks), F.lit(0))
    dealt = copies.repartition(part_count(classes.sparkSession), "t", head)

    def walk(frames):
        rows: list[list[np.ndarray]] = [[] for _ in range(blocks)]
        for frame in frames:
            fps, t = frame["fp"].to_numpy(np.int64), frame["t"].to_numpy()
            for i in range(blocks):
                rows[i].append(fps[t == i])
        for i in range(blocks):
            fps = np.concatenate([np.zeros(0, dtype=np.int64), *rows[i]])
            keys = turned(fps.view(np.uint64), i, blocks)
            order = np.argsort(keys)
            first = linked(keys[order], block_bits(i, blocks), budget)
            away = np.flatnonzero(first != np.arange(len(first)))
            fps = fps[order]
            yield pd.DataFrame({"a": fps[away], "b": fps[first[away]]})

    return dealt.mapInPandas(walk, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of undirected edges (a, b): root is the smallest in reach."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Each node's larger (large star) or smaller neighbours, tied to its smallest."""
        if large:
            around = pairs.union(pairs.select(F.col("b"), F.col("a")))
        else:
            around = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        tied = around.join(least, around["a"] == least["u"])
        tied = tied.filter(F.col("b") > F.col("a")) if large else tied
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(least.select("u", "m"))
        return out.filter(F.col("a") != F.col("b")).distinct()

    def state(pairs: DataFrame):
        row = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return tuple(row)

    pairs = materialize(edges.filter(F.col("a") != F.col("b")).distinct())
    before = state(pairs)
    while before[0]:
        pairs = materialize(star(star(pairs, True), False))
        now = state(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, the row's key, fp and component_id, the smallest doc_id reachable over links."""
    marked = materialize(fingerprints(docs))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(classes.select("fp"), budget))
    # only classes with links need more than their own smallest doc_id
    tied = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    named = tied.join(ids, "root").select(
        F.col("fp").alias("f"), F.col("root").alias("component"), "component_id"
    )
    return marked.join(named, marked["fp"] == named["f"]).drop("f")


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, all columns kept.

    It is that with the smallest doc_id (nulls last), of several with this doc_id that whose text
    has the smallest hash, and any one of rows that repeat both.
    """
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__h", "__id")
    kept = near_duplicates(docs).groupBy("component").agg(F.min(first).alias("k")).select(
        F.col("k.__id").alias("__id"), F.col("k.__h").alias("__h")
    )
    # the row as one column: no name of its own can clash with ours
    own = docs.select(F.struct("*").alias("row"), *_key()).join(kept, ["__id", "__h"], "left_semi")
    return own.dropDuplicates(["__id", "__h"]).select("row.*")
