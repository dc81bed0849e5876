"""Document fingerprints: Merkle trees over sections, paragraphs and sentences.

A paragraph is a line; its leaves are its sentences. A section ends before a heading-like or blank
line, or after a paragraph whose hash is divisible by ``SPREAD``, so that section borders depend on
nearby text alone and an edit moves no border further on. Each node's hash is that of its
children's hashes, so equal roots mean equal texts, and unequal ones are followed down to the
leaves that differ.

The fingerprint is the tree as text: the root (32 hex digits), then for each section its hash, its
paragraphs and their leaves with lengths. Edits and likeness are read from two fingerprints alone:
equal branches are aligned in order, level by level, and only what lies between them is opened. So
moved, inserted and deleted leaves are located in both texts. Likeness is the share of characters in
aligned leaves, and 1 for equal roots only.

Null counts as the empty text. Equal texts have equal fingerprints, and likeness 1. Documents follow
each other by doc_id, nulls first, and rows with one doc_id by a hash of their text; after the last
comes the first, which a single row is to itself. Columns other than doc_id and text are not looked
at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, bounds_of, doc_columns, in_range, part_count

SPREAD = 8
_SENTENCE = re.compile(r"[^.!?\n]*[.!?]+\s*|[^.!?\n]+")
#: Leaves without a sentence end are cut after so many characters.
LONGEST = 400


def _hash(data: bytes, size: int) -> str:
    return hashlib.blake2b(data, digest_size=size).hexdigest()


def leaves_of(paragraph: str) -> list[str]:
    parts = _SENTENCE.findall(paragraph)
    return [p[i : i + LONGEST] for p in parts for i in range(0, len(p), LONGEST)]


def tree(text: str | None) -> list[list[list[tuple[str, int]]]]:
    """Sections of paragraphs of leaves, each leaf a hash and its number of characters."""
    sections: list[list[list[tuple[str, int]]]] = [[]]
    for line in re.split(r"(?<=\n)", text or ""):
        if not line:
            continue
        leaves = [(_hash(x.encode("utf-8", "surrogatepass"), 6), len(x)) for x in leaves_of(line)]
        if line.endswith("\n"):
            leaves.append((_hash(b"\n", 6), 1))
        heading = line.startswith("#") or not line.strip()
        if heading and sections[-1]:
            sections.append([])
        sections[-1].append(leaves)
        if int(_hash("".join(h for h, _ in leaves).encode(), 2), 16) % SPREAD == 0:
            sections.append([])
    return [s for s in sections if s]


def fingerprint(text: str | None) -> str:
    """root|section;section;... with a section as hash:paragraph/paragraph, leaves as hash.length."""
    parts = []
    for section in tree(text):
        paragraphs = ["_".join(f"{h}.{n:x}" for h, n in p) for p in section]
        nodes = "".join(_hash(p.encode(), 8) for p in paragraphs)
        parts.append(f"{_hash(nodes.encode(), 8)}:{'/'.join(paragraphs)}")
    root = _hash("".join(p[:16] for p in parts).encode(), 16)
    return f"{root}|{';'.join(parts)}"


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal entries, ascending in both lists.

    The nth occurrence of an entry meets the nth one of the other list; of these pairs a longest ascending row stays.
    """
    places: dict[str, deque[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, deque()).append(j)
    pairs = [(i, places[x].popleft()) for i, x in enumerate(a) if places.get(x)]
    ends: list[int] = []  # the smallest end in b of an ascending row of each length
    last: list[int] = []  # the pair it belongs to
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        before.append(last[at - 1] if at else -1)
        if at == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[at], last[at] = j, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _gaps(a: list[str], b: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of both lists between aligned entries."""
    i = j = 0
    for x, y in [*_aligned(a, b), (len(a), len(b))]:
        if x > i or y > j:
            yield i, x, j, y
        i, j = x + 1, y + 1


def _paragraphs(sections: list[str]) -> list[str]:
    return [p for s in sections for p in s[17:].split("/")]


def _leaves(paragraphs: list[str]) -> list[str]:
    return [x for p in paragraphs for x in p.split("_") if x]


def _length(leaves: list[str]) -> int:
    return sum(int(x.rpartition(".")[2], 16) for x in leaves)


def edits(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Where two fingerprints' texts differ: leaves from, to of ``a`` stand for leaves from, to of ``b``.

    An empty range of ``a`` is an insertion, one of ``b`` a deletion; a moved leaf is one of each.
    """
    if a[:32] == b[:32]:
        return []
    left, right = (list(filter(None, x[33:].split(";"))) for x in (a, b))
    # leaves before each section, and within a gap before each paragraph
    starts = [np.cumsum([0, *(len(_leaves(_paragraphs([s]))) for s in side)]).tolist() for side in (left, right)]
    out = []
    for i, x, j, y in _gaps(left, right):
        ps, qs = _paragraphs(left[i:x]), _paragraphs(right[j:y])
        p_starts, q_starts = (np.cumsum([0, *(len(_leaves([p])) for p in side)]).tolist() for side in (ps, qs))
        for k, u, m, v in _gaps(ps, qs):
            from_a, from_b = starts[0][i] + p_starts[k], starts[1][j] + q_starts[m]
            for c, d, e, f in _gaps(_leaves(ps[k:u]), _leaves(qs[m:v])):
                out.append((from_a + c, from_a + d, from_b + e, from_b + f))
    return out


def likeness(a: str, b: str) -> float:
    """Share of both texts' characters that lie in aligned leaves of both trees, from 0 to 1."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = (list(filter(None, x[33:].split(";"))) for x in (a, b))
    apart = whole = 0
    for side in (left, right):
        whole += _length(_leaves(_paragraphs(side)))
    for i, x, j, y in _gaps(left, right):
        ps, qs = _paragraphs(left[i:x]), _paragraphs(right[j:y])
        for k, u, m, v in _gaps(ps, qs):
            xs, ys = _leaves(ps[k:u]), _leaves(qs[m:v])
            for c, d, e, f in _gaps(xs, ys):
                apart += _length(xs[c:d]) + _length(ys[e:f])
    return (whole - apart) / whole if whole else 1.0


def differing(a: str, b: str) -> list[int]:
    """Numbers of the leaves of ``a`` that have no place in ``b``."""
    return [n for start, end, _, _ in edits(a, b) for n in range(start, end)]


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt out by ranges of doc_id and in order, each range with the row after its last.

    Columns: doc_id, text, part, tail; a row with ``tail`` only ends its range.
    """
    spark: SparkSession = docs.sparkSession
    docs = doc_columns(docs)
    parts = part_count(spark)
    bounds = bounds_of(docs, parts)
    placed = docs.withColumn("part", in_range(bounds))
    firsts = sorted(
        (r["part"], r["least"], r["nulls"])
        for r in docs.select("doc_id").withColumn("part", in_range(bounds)).groupBy("part").agg(
            F.coalesce(F.min("doc_id"), F.lit(0)).alias("least"),
            F.count_if(F.col("doc_id").isNull()).alias("nulls"),
        ).collect()
    )
    # the range before that of each first row; before the first of all comes the last
    before = {p: firsts[i - 1][0] for i, (p, *_) in enumerate(firsts)}
    own = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("tail")))
    if firsts:
        previous = F.create_map(*[F.lit(x).cast("int") for kv in before.items() for x in kv])
        least = F.create_map(*[x for p, v, _ in firsts for x in (F.lit(p).cast("int"), F.lit(v))])
        with_nulls = [p for p, _, nulls in firsts if nulls]
        first = F.when(
            F.col("part").isin(with_nulls), F.col("doc_id").isNull()
        ).otherwise(F.col("doc_id") == least[F.col("part")]) if with_nulls else (
            F.col("doc_id") == least[F.col("part")]
        )
        also = F.struct(previous[F.col("part")].alias("part"), F.lit(True).alias("tail"))
        own = F.when(first, F.array_union(own, F.array(also))).otherwise(own)
    spread = placed.select("doc_id", "text", F.explode(own).alias("p")).select(
        "doc_id", "text", "p.part", "p.tail"
    )
    return spread.repartitionById(parts, F.col("part") % parts).sortWithinPartitions(
        "part", "tail", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"
    )


def report(docs: DataFrame) -> DataFrame:
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )

    def pairs(frames):
        held, part = None, None  # the row that waits for the one after it
        for frame in frames:
            out = []
            rows = zip(
                frame["id"], frame["known"], frame["text"], frame["part"], frame["tail"],
                strict=True,
            )
            for doc, known, text, p, tail in rows:
                text = text or ""
                print_ = fingerprint(text)
                if p != part:
                    held, part = None, p
                if held is not None:
                    a_doc, a, a_print = held
                    changed = edited(a, text)
                    c_print = a_print if changed == a else fingerprint(changed)
                    digest = hashlib.sha256(as_bytes([changed])[0]).hexdigest()
                    out.append((
                        a_doc, len(a), digest, a_print, c_print, likeness(a_print, c_print),
                        likeness(a_print, print_),
                    ))
                held = None if tail else ((int(doc) if known else None), text, print_)
            yield _frame(out)

    placed = with_next(docs).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"),
        "text", "part", "tail",
    )
    return placed.mapInPandas(pairs, schema)


_NAMES = (
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
    "near_next",
)


def _frame(rows) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_NAMES)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    frame["n_chars"] = frame["n_chars"].astype(np.int64)
    return frame.astype({"near_edited": float, "near_next": float})
