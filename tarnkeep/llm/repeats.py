"""Removal of long repeated strings by run-length compressed Burrows-Wheeler indexes.

Every byte in a string of ``LENGTH`` bytes that also starts elsewhere in the corpus is to go. A corpus
has no single index: it is cut so that all equal strings meet in one.

1. Anchors. Of the ``GRAM``-byte grams that start in a window of ``LENGTH`` bytes, the one with the
   smallest hash is its anchor. Equal windows have equal anchors at equal places, and windows one
   byte apart mostly share theirs. An anchor's context is all its windows together.
2. Contexts that occur twice are repeated as a whole. Tasks see to those within their part of the
   corpus and pass on one of each, so that a text with any number of copies is passed on once a task.
3. The others of an anchor gram with several contexts go to one index: contexts are joined, suffixes
   sorted, the Burrows-Wheeler transform taken and its runs found. Only at the ends of runs are
   matches of neighbouring suffixes measured; inside a run the match is that of the text position
   before less one. Streaming these statistics in text order gives each position's longest match.
   Classes of suffixes that agree for ``LENGTH`` bytes and lie at different places are repeated.
4. An anchor gram with more than ``CROWD`` contexts has no index of its own. Its windows are counted
   by hash over the cluster, however many there are.

Hashes that are compared over the cluster have 96 bits or more. Null texts count as empty. Repeated
rows are copies of each other like any others. Empty and short texts keep all bytes; an empty table
gives an empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, materialize, part_count

LENGTH = 200
GRAM = 64
#: Contexts of one anchor gram that are indexed together at most.
CROWD = 4096
#: Bytes of contexts for one index, anchor grams being kept together.
INDEX_BYTES = 1 << 20
BEYOND = 0xFF  # a byte that UTF-8 never has

_U = np.uint64
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class _Powers:
    """Powers of the hash factor and of its inverse, as far as a text is long."""

    def __init__(self) -> None:
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 12)
            self.up, self.down = (self._series(f) for f in (_FACTOR, _INVERSE))
        return self.up[:n], self.down[:n]

    def _series(self, factor: int) -> np.ndarray:
        out = np.full(self.n, factor, dtype=_U)
        out[0] = 1
        return np.cumprod(out)


_powers = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


class Hashes:
    """Hashes of any substrings of a text, by prefix sums."""

    def __init__(self, text: bytes, seed: int = 0) -> None:
        a = np.frombuffer(text, np.uint8).astype(_U) + _U(1)
        if seed:  # another value for each byte gives an independent hash
            a = _mixed(a + _U(seed))
        up, self._down = _powers.upto(len(text) + 1)
        self._sums = np.zeros(len(text) + 1, dtype=_U)
        np.cumsum(a * up[: len(text)], out=self._sums[1:])

    def of(self, start, end) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[start]) * self._down[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self._sums) - size
        return _mixed((self._sums[size:] - self._sums[:n]) * self._down[:n])


def _sliding(values: np.ndarray, width: int, best, filler) -> np.ndarray:
    """The best of every ``width`` neighbouring values."""
    n = len(values)
    rows = np.full(-(-n // width) * width, filler, dtype=values.dtype)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    left = best.accumulate(rows, axis=1).ravel()
    right = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(right[: n - width + 1], left[width - 1 : n])


def anchors(hashes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Places of the grams that are smallest in some window."""
    width = length - gram + 1
    if len(hashes) < width:
        return np.zeros(0, dtype=np.int64)
    least = _sliding(hashes, width, np.minimum, _U(2**64 - 1))
    # a gram is an anchor if the greatest minimum of the windows around it is its own hash
    around = np.concatenate([np.zeros(width - 1, _U), least, np.zeros(width - 1, _U)])
    return np.flatnonzero(_sliding(around, width, np.maximum, _U(0)) == hashes)


def intervals(starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Merged [from, to) of windows at ascending starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + length


# ---- the index ----


def suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted suffixes of texts that each end with a separator, by prefix doubling.

    ``ends``: for each place, how far its separator is. Separators are larger than all bytes, and
    differ: that of an earlier text is smaller.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(_U)
    key = np.zeros(n, dtype=_U)
    for i in range(8):
        key = (key << _U(8)) | np.where(ends >= i, padded[i : i + n], _U(0))
    order = np.argsort(key, kind="stable")
    key, own = key[order], ends[order] < 8  # a separator within reach tells suffixes apart
    new = np.ones(n, dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | own[1:] | own[:-1]
    rank = np.empty(n, dtype=np.int64)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    step = 8
    while True:
        # suffixes whose order isn't final stand next to one that is equal so far
        open_ = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(open_):
            return order
        at = order[open_]
        pair = rank[at] * n + rank[at + step]
        sort = np.argsort(pair, kind="stable")
        at, pair = at[sort], pair[sort]
        order[open_] = at
        new[open_] = np.append(True, pair[1:] != pair[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[at] = first[open_]
        step *= 2


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, with matches sampled at run ends."""

    def __init__(self, texts: list[bytes]) -> None:
        self.begins = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
        self.text = np.frombuffer(b"".join([t + b"\xff" for t in texts]), np.uint8)
        n = len(self.text)
        self.ends = np.repeat(self.begins[1:] - 1, np.diff(self.begins)) - np.arange(n)
        self.order = suffix_array(self.text, self.ends)
        before = self.text[self.order - 1]
        # separators differ from each other, so each is a run of its own
        head = np.ones(n, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == BEYOND)
        self.run_heads = np.flatnonzero(head)
        self.run_symbols = before[self.run_heads]
        #: Text places at run heads, and their matches with the suffix before them.
        self.samples = self.order[self.run_heads]
        self.sampled = np.zeros(len(self.samples), dtype=np.int64)
        self.sampled[1:] = self._common(self.order[self.run_heads[1:] - 1], self.samples[1:])

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes, which end before separators."""
        padded = np.concatenate([self.text, np.zeros(16, np.uint8)])
        words = np.lib.stride_tricks.sliding_window_view(padded, 8)
        most = np.minimum(self.ends[a], self.ends[b])
        out = np.zeros(len(a), dtype=np.int64)
        active = np.arange(len(a))
        while len(active):
            x, y = a[active] + out[active], b[active] + out[active]
            same = words[x] == words[y]
            agree = np.where(same.all(axis=1), 8, same.argmin(axis=1))
            out[active] += agree
            active = active[(agree == 8) & (out[active] < most[active])]
        return np.minimum(out, most)

    def matching_statistics(self) -> np.ndarray:
        """In suffix order, the longest match of each suffix with the one before it."""
        value = np.zeros(len(self.text), dtype=np.int64)
        value[self.samples] = self.sampled + self.samples
        known = np.zeros(len(self.text), dtype=np.int64)
        known[self.samples] = self.samples
        last = np.maximum.accumulate(known)
        streamed = value[last] - np.arange(len(self.text))
        return streamed[self.order]

    def repeated(self, rows: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> np.ndarray:
        """Text places whose next ``length`` bytes also start at another place of the corpus.

        ``rows`` and ``offsets``: the document of each text, and the place in it where it begins.
        """
        match = self.matching_statistics() >= length
        first = np.flatnonzero(match & ~np.append(False, match[:-1])) - 1
        if not len(first):
            return np.zeros(0, dtype=np.int64)
        member = match | np.append(match[1:], False)
        members = np.flatnonzero(member)
        begin = np.searchsorted(members, first)
        places = self.order[members]
        which = np.searchsorted(self.begins, places, side="right") - 1
        row, at = rows[which], offsets[which] + places - self.begins[which]
        differ = np.zeros(len(begin), dtype=bool)
        for x in (row, at):
            differ |= np.minimum.reduceat(x, begin) != np.maximum.reduceat(x, begin)
        return places[np.repeat(differ, np.diff(np.append(begin, len(members))))]


# ---- on the cluster ----


def _row() -> list[Column]:
    """Two numbers that name a row by its doc_id and text."""
    return [
        F.xxhash64("doc_id", "text").alias("row"),
        F.coalesce(F.col("doc_id"), F.lit(-1)).bitwiseAND(0x7FFFFFFF).alias("low"),
    ]


_FOUND = "kind int, key long, context long, row long, low long, at int, left int, right int"
_MARK, _CONTEXT, _WINDOW = 0, 1, 2


def _frame(kind: int, key, context, row, low, at, left, right) -> pd.DataFrame:
    return pd.DataFrame({
        "kind": np.int32(kind), "key": key, "context": context, "row": row, "low": low,
        "at": np.asarray(at, np.int32), "left": np.asarray(left, np.int32),
        "right": np.asarray(right, np.int32),
    })


def _twice(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group starts in it) that bring equal tuples together."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return order, np.flatnonzero(new)


def _contexts(docs: DataFrame) -> DataFrame:
    """Marks of contexts that repeat in a task; of all others and one of each of these, a row.

    A row whose ``left`` is negative stands for contexts already marked.
    """

    def find(frames):
        held: list[tuple] = []
        size = 0

        def flush():
            key, context, row, low, at, left, right = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            order, first = _twice(key, context)
            count = np.diff(np.append(first, len(order)))
            many = np.repeat(count > 1, count)
            i = order[many]
            yield _frame(_MARK, 0, 0, row[i], low[i], at[i], left[i], right[i])
            i = order[first]
            yield _frame(
                _CONTEXT, key[i], context[i], row[i], low[i], at[i],
                np.where(count > 1, -1 - left[i], left[i]), right[i],
            )

        for frame in frames:
            for text, row, low in zip(
                as_bytes(frame["text"]), frame["row"].to_numpy(np.int64),
                frame["low"].to_numpy(np.int64), strict=True,
            ):
                if len(text) < LENGTH:
                    continue
                h = Hashes(text)
                grams = h.grams(GRAM)
                at = anchors(grams)
                left = np.minimum(at, LENGTH - GRAM)
                right = np.minimum(len(text) - at, LENGTH)
                shape = (left * (LENGTH + 1) + right).astype(_U)
                context = _mixed(h.of(at - left, at + right) + shape * _U(_FACTOR))
                n = len(at)
                held.append((
                    grams[at].view(np.int64), context.view(np.int64), np.full(n, row),
                    np.full(n, low), at, left, right,
                ))
                size += n
            if size > 1_500_000:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return docs.select("text", *_row()).mapInPandas(find, _FOUND)


def _judged(contexts: DataFrame) -> DataFrame:
    """Marks, and rows of the contexts that an index must look at (``key`` told apart by it)."""

    def judge(frames):
        rest = None

        def groups(frame):
            key, context = frame["key"].to_numpy(), frame["context"].to_numpy()
            order, first = _twice(key, context)
            frame = frame.iloc[order]
            count = np.diff(np.append(first, len(order)))
            known = frame["left"].to_numpy() < 0
            repeated = (count > 1) | np.logical_or.reduceat(known, first)
            new_key = np.append(True, np.diff(frame["key"].to_numpy()[first]) != 0)
            key_first = np.flatnonzero(new_key)
            kinds = np.diff(np.append(key_first, len(first)))
            several = np.repeat(kinds > 1, kinds)
            # all rows of repeated contexts but those whose task has marked them
            whole = frame[np.repeat(repeated, count) & ~known]
            yield whole.assign(kind=np.int32(_MARK))
            # one of each context where an anchor gram has several and not all are marked
            unmarked = np.repeat(np.add.reduceat(~repeated, key_first) > 0, kinds)
            ask = frame.iloc[first[several & unmarked]]
            left = ask["left"].to_numpy()
            yield ask.assign(kind=np.int32(_CONTEXT), left=np.where(left < 0, -1 - left, left))

        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = frame["key"].to_numpy() == frame["key"].iloc[-1]
            rest = frame[last]
            if (~last).any():
                yield from groups(frame[~last])
        if rest is not None:
            yield from groups(rest)

    parts = part_count(contexts.sparkSession)
    return contexts.repartition(parts, "key").sortWithinPartitions("key").mapInPandas(judge, _FOUND)


def _indexed(contexts: DataFrame) -> DataFrame:
    """Marks by indexes over the contexts of each anchor gram."""

    def index(frames):
        held: list[pd.DataFrame] = []
        size = 0

        def flush():
            frame = pd.concat(held, ignore_index=True)
            held.clear()
            texts = list(frame["bytes"])
            rows, offsets = frame["row"].to_numpy(), frame["at"].to_numpy().astype(np.int64)
            made = RunLengthIndex(texts)
            places = np.sort(made.repeated(rows, offsets))
            which = np.searchsorted(made.begins, places, side="right") - 1
            out = []
            cut = np.flatnonzero(np.diff(which)) + 1
            for part in np.split(np.arange(len(places)), cut):
                if len(part):
                    w = which[part[0]]
                    s, e = intervals(places[part] - made.begins[w] + offsets[w])
                    out += [(rows[w], frame["low"].iloc[w], a, b) for a, b in zip(s, e, strict=True)]
            return pd.DataFrame(out, columns=["row", "low", "s", "e"])

        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = frame["key"].to_numpy() == frame["key"].iloc[-1]
            rest, frame = frame[last], frame[~last]
            # anchor grams one after another, as many as make an index
            for _, group in frame.groupby("key", sort=False):
                held.append(group)
                size += int(group["bytes"].map(len).sum())
                if size >= INDEX_BYTES:
                    yield flush()
                    size = 0
        if rest is not None:
            held.append(rest)
        if held:
            yield flush()

    parts = part_count(contexts.sparkSession)
    return contexts.repartition(parts, "key").sortWithinPartitions("key").mapInPandas(
        index, "row long, low long, s int, e int"
    )


_CUT = "kind int, key long, key2 long, row long, low long, at int, bytes binary"


def _cut_out(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """Bytes of the contexts to index, and hashes of all windows of crowded anchor grams."""
    lists = asked.groupBy("row", "low").agg(F.collect_list(
        F.struct("key", "at", "left", "right", "crowded")
    ).alias("asked"))
    joined = docs.select("text", *_row()).join(lists, ["row", "low"])

    def cut(frames):
        for frame in frames:
            out, windows = [], []
            for text, row, low, asked_ in zip(
                as_bytes(frame["text"]), frame["row"], frame["low"], frame["asked"], strict=True
            ):
                starts = [np.zeros(0, dtype=np.int64)]
                for x in asked_:
                    a, b = x["at"] - x["left"], x["at"] + x["right"]
                    if x["crowded"]:
                        starts.append(np.arange(a, min(x["at"], b - LENGTH) + 1))
                    else:
                        out.append((_CONTEXT, x["key"], 0, row, low, a, text[a:b]))
                at = np.unique(np.concatenate(starts))
                if len(at):
                    one, two = (Hashes(text, seed).of(at, at + LENGTH) for seed in (0, 7))
                    windows.append((one, two, np.full(len(at), row), np.full(len(at), low), at))
            yield pd.DataFrame(
                out, columns=["kind", "key", "key2", "row", "low", "at", "bytes"]
            ).astype({"kind": "int32", "at": "int32", "key": "int64", "key2": "int64"})
            if windows:
                one, two, row, low, at = map(np.concatenate, zip(*windows, strict=True))
                yield pd.DataFrame({
                    "kind": np.int32(_WINDOW), "key": one.view(np.int64),
                    "key2": two.view(np.int64), "row": row, "low": low,
                    "at": at.astype(np.int32), "bytes": None,
                })

    return joined.mapInPandas(cut, _CUT)


def _counted(windows: DataFrame) -> DataFrame:
    """Marks of windows whose hash occurs at several places."""
    counts = windows.groupBy("key", "key2").agg(F.count("*").alias("n")).filter("n > 1")
    again = windows.join(counts.select("key", "key2"), ["key", "key2"], "left_semi")
    return again.select("row", "low", F.col("at").alias("s"), (F.col("at") + LENGTH).alias("e"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """row, low and spans: byte ranges of each text, not merged, that repeat elsewhere."""
    docs = doc_columns(docs)
    found = materialize(_contexts(docs), ["kind"])
    contexts = found.filter(F.col("kind") == _CONTEXT)
    judged = materialize(_judged(contexts), ["kind"])
    asked = judged.filter(F.col("kind") == _CONTEXT)
    crowds = asked.groupBy("key").count().filter(F.col("count") > CROWD).select(
        F.col("key").alias("k")
    )
    asked = asked.join(crowds, asked["key"] == F.col("k"), "left").withColumn(
        "crowded", F.col("k").isNotNull()
    )
    cut = materialize(_cut_out(asked, docs), ["kind"])
    whole = found.filter(F.col("kind") == _MARK).unionByName(
        judged.filter(F.col("kind") == _MARK)
    ).select(
        "row", "low", (F.col("at") - F.col("left")).alias("s"),
        (F.col("at") + F.col("right")).alias("e"),
    )
    marks = whole.union(_indexed(cut.filter(F.col("kind") == _CONTEXT))).union(
        _counted(cut.filter(F.col("kind") == _WINDOW))
    )
    return marks.groupBy("row", "low").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def without(text: bytes, spans) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(text[at:s])
        at = e
    return b"".join([*parts, text[at:]])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    own = doc_columns(docs)
    joined = own.select("doc_id", "text", *_row()).join(repeated_spans(docs), ["row", "low"], "left")

    def remove(frames):
        for frame in frames:
            out = []
            for doc, text, spans in zip(
                frame["id"], as_bytes(frame["text"]), frame["spans"], strict=True
            ):
                spans = merged(spans if spans is not None else ())
                digest = hashlib.sha256(without(text, spans)).hexdigest()
                out.append((doc, len(text), sum(e - s for s, e in spans), len(spans), digest))
            yield pd.DataFrame(
                out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    schema = "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select(F.col("doc_id").cast("string").alias("id"), "text", "spans").mapInPandas(
        remove, schema
    ).select(
        F.col("id").cast("long").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
