"""Benchmark decontamination with a generalised suffix automaton of the test items.

Test items become sequences of word numbers in one suffix automaton. Document words are streamed
through it and the longest match that ends at each word is tracked; a match of ``window`` words or
more, or a whole item shorter than that, hits all its words. Only stretches of words that all
occur in some item, long enough for the shortest window, need streaming: no match can leave them.

The items are read in blocks of at most ``BLOCK_WORDS`` words, one automaton each, so what is
broadcast has a fixed bound whatever the size of the benchmark; a document's results over the
blocks are joined by union.

Nulls and texts without words have no words and are clean. Items that repeat count once per item_id;
a null item_id is the empty string; an empty benchmark leaves everything clean. Rows of documents are
independent of each other. Columns other than doc_id, text and item_id are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, per_text

WINDOW = 13
#: Words from which on a span goes from any document.
LONGEST = 50
BLOCK_WORDS = 200_000
_WORD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A
    else 32
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class SuffixAutomaton:
    """All word sequences that occur in the items, with the items a window occurs in."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = min([window, *(len(w) for _, w in items if w)])
        ends: list[tuple[int, str]] = []
        wholes = []
        for item, sequence in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in sequence]
            last = 0
            for x in ids:
                last = self._extend(last, x)
                ends.append((last, item))
            if 0 < len(ids) < window:
                wholes.append((item, ids))
        n = len(self.next)
        # the items a state's sequences occur in, needed where a length of ``window`` lies
        self.items: dict[int, set[str]] = {}
        self.at_window = [-1] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= window:
                self.at_window[s] = s if self.length[up] < window else self.at_window[up]
        for s, item in ends:
            if self.at_window[s] >= 0:
                self.items.setdefault(self.at_window[s], set()).add(item)
        # whole items shorter than the window, by the state that holds them
        self.whole: dict[int, list[tuple[int, str]]] = {}
        for item, ids in wholes:
            s = 0
            for x in ids:
                s = self.next[s][x]
            self.whole.setdefault(s, []).append((len(ids), item))
        self.whole_up = [-1] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            self.whole_up[s] = s if s in self.whole else self.whole_up[self.link[s]]

    def _add(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, x: int, q: int) -> int:
        clone = self._add(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, x: int) -> int:
        q = self.next[last].get(x)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, x, q)
        current = self._add(self.length[last] + 1)
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = current
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[current] = (
                q if self.length[q] == self.length[p] + 1 else self._split(p, x, q)
            )
        return current

    def stream(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of ``ids`` that windows cover, and the items these windows are of."""
        spans, found = [], set()
        state = matched = 0
        for i, x in enumerate(ids):
            while state and x not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if x in self.next[state]:
                state = self.next[state][x]
                matched += 1
            if matched >= self.window:
                spans.append((i + 1 - matched, i + 1))
                found |= self.items.get(self.at_window[state], set())
            s = self.whole_up[state]
            while s > 0:
                for n, item in self.whole[s]:
                    if n <= matched:
                        spans.append((i + 1 - n, i + 1))
                        found.add(item)
                s = self.whole_up[self.link[s]] if self.link[s] > 0 else -1
        return spans, found

    def match(self, sequence: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans of a document that windows cover, and the items."""
        if len(sequence) < self.shortest or not self.vocabulary:
            return [], set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in sequence), np.int64, len(sequence))
        known = np.zeros(len(ids) + 2, dtype=np.int8)
        known[1:-1] = ids >= 0
        edges = np.flatnonzero(known[1:] != known[:-1])
        spans, found = [], set()
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s >= self.shortest:
                got, items = self.stream(ids[s:e].tolist())
                spans += [(s + a, s + b) for a, b in got]
                found |= items
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def automata(
    benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> list:
    """Broadcasts of one automaton for each block of items."""
    context = benchmark.sparkSession.sparkContext
    blocks, block, size = [], [], 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string")
    )
    for item, text in rows.toLocalIterator():
        sequence = words(as_bytes([text])[0])
        if block and size + len(sequence) > block_words:
            blocks.append(context.broadcast(SuffixAutomaton(block, window)))
            block, size = [], 0
        block.append((item, sequence))
        size += len(sequence)
    return [*blocks, context.broadcast(SuffixAutomaton(block, window))]


def _matches(block) -> Column:
    schema = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"

    def make():
        automaton = block.value

        def of(texts):
            rows = []
            for text in as_bytes(texts):
                sequence = words(text)
                spans, items = automaton.match(sequence)
                rows.append((
                    len(sequence), [{"start": s, "end": e} for s, e in spans], sorted(items)
                ))
            return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

        return of

    return per_text(make, schema, "text")


def hits(docs: DataFrame, blocks: list) -> DataFrame:
    """``row``, a document's columns, and the struct ``hits``: n_words, n_hit, spans (in words), items."""
    # the row as one column: no name of its own can clash with ours
    docs = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    names = [f"__block_{i}" for i in range(len(blocks))]
    for name, block in zip(names, blocks, strict=True):
        docs = docs.withColumn(name, _matches(block))

    def make():
        def of(*columns):
            rows = []
            for parts in zip(*columns, strict=True):
                spans = merged([(s["start"], s["end"]) for p in parts for s in p])
                rows.append((
                    sum(e - s for s, e in spans), [{"start": s, "end": e} for s, e in spans]
                ))
            return pd.DataFrame(rows, columns=["n_hit", "spans"])

        return of

    if len(names) == 1:
        spans = F.col(names[0])["spans"]
        n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    else:
        schema = "n_hit long, spans array<struct<start:int,end:int>>"
        docs = docs.withColumn(
            "__union", per_text(make, schema, *[F.col(n)["spans"] for n in names])
        )
        spans, n_hit = F.col("__union")["spans"], F.col("__union")["n_hit"]
        names.append("__union")
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.col(n)["items"] for n in names if n != "__union"
    ]))))
    together = F.struct(
        F.col(names[0])["n_words"].alias("n_words"), n_hit.alias("n_hit"), spans.alias("spans"),
        items.alias("items"),
    )
    return docs.select("row", together.alias("hits"))


def is_contaminated(share: int = 20) -> Column:
    """Hit words make up at least one in ``share`` of the words."""
    return (F.col("hits.n_hit") > 0) & (share * F.col("hits.n_hit") >= F.col("hits.n_words"))


def kept_documents(docs: DataFrame, blocks: list) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    return hits(docs, blocks).filter(~is_contaminated()).select("row.*")


def without_passages(docs: DataFrame, blocks: list, longest: int = LONGEST) -> DataFrame:
    """All documents, their texts without the spans that exceed a limit.

    A span of ``longest`` words or more goes, and every span of a contaminated document does.
    """
    marked = hits(docs, blocks)
    names = [_without(longest).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return marked.select(*names)


def report(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    marked = hits(doc_columns(docs), automata(benchmark, block_words=block_words))
    return marked.select(
        "row.doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        F.sha2(F.coalesce(_without(LONGEST), F.lit("")), 256).alias("kept_sha256"),
    )


def removed_spans(text: str, spans) -> str:
    """``text`` without the words of ``spans``; what stands between words stays."""
    raw = as_bytes([text])[0]
    flat = raw.translate(_WORD)
    places, at = [], 0
    for w in words(raw):
        at = flat.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, at = [], 0
    for s in spans:
        first, last = places[s["start"]][0], places[s["end"] - 1][1]
        out.append(raw[at:first])
        at = last
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def _without(longest: int) -> Column:
    """The text less the spans that exceed a limit."""
    gone = F.filter("hits.spans", lambda s: is_contaminated() | (s["end"] - s["start"] >= longest))
    text = F.col("row.text").cast("string")

    def make():
        def of(texts, spans):
            return pd.DataFrame({"text": [
                None if t is None else removed_spans(t, s) for t, s in zip(texts, spans, strict=True)
            ]})

        return of

    # only texts that lose something go to Python
    cut = per_text(make, "text string", F.when(F.size(gone) > 0, text), gone)["text"]
    return F.coalesce(cut, text)
