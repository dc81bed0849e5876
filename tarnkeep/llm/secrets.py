"""Secret scans: stated patterns, and formats learned from what they find by grammar inference.

The patterns label credentials. From a bounded sample of them (``SAMPLE`` values of each kind, those
with the smallest hashes over the whole corpus, up to ``LEARNED`` bytes of each; a value that is cut
teaches no end) an automaton per kind is inferred (ALERGIA). Nodes of the prefix tree with fewer than
``EVIDENCE`` values say too little by themselves; those of one depth are taken together, so that a
format keeps its length. States are then merged while their outgoing frequencies, the end among them,
agree within a Hoeffding bound; a merge folds what follows as well, and is given up where the counts
so far disagree. States with fewer than ``EVIDENCE`` values are left as they are.

Every run of credential characters in every text that is not wholly inside base spans, and has the
length of the shortest learned value or more, is scored by each automaton. A run becomes a span of
kind ``format`` if its likelihood per character is at least that of the lowest per cent of labelled
values, and above that of ordinary runs. All distinct labelled values of the corpus are scored for that,
whole, each by an automaton learned without it: those of the sample in ``PARTS`` parts in turn.

Nulls, empty texts and texts without runs have no spans. Rows are independent of each other, so
repeated rows give equal results; an empty table gives an empty result and learns nothing, then
only the patterns count. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict, deque

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, materialize, per_text

KINDS = ("assign", "access", "hex", "format")
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
_RUN = np.isin(np.arange(256), np.frombuffer(_ALNUM + b"+/_=-", np.uint8))
_DOT = ord(".")

#: Credentials of each kind, and ordinary runs, that the automata are learned from.
SAMPLE = 400
#: Bytes of a sampled value that are learned from; scoring always takes whole values.
LEARNED = 4096
#: Bytes of labelled values that a task holds before it passes them on.
HELD_BYTES = 1 << 24
#: Bytes up to which a scored value is remembered by its task.
REMEMBERED = 256
#: The shortest value of a pattern, and so the shortest run that can be one.
SHORTEST = 6
#: Values that a state needs to be compared with others, or to stand for itself.
EVIDENCE = 25
#: Characters after which a format's positions are no longer told apart.
DEPTH = 128
#: Merge test: a lower value merges more.
ALPHA = 0.05
#: Parts of the labelled values that are scored by what the other parts teach.
PARTS = 4


def _runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of marked places with ``least`` places or more."""
    if len(inside) < least:
        return []
    marks = np.zeros(len(inside) + 2, dtype=np.int8)
    marks[1:-1] = inside
    edges = np.flatnonzero(marks[1:] != marks[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def base_spans(text: bytes) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) in bytes, by start and then by kind."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        found += [
            (m.start(), m.end(), "assign", m.start(1))
            for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6
        ]
    if b"AKIA" in text:
        found += [
            (m.start(), m.end(), "access", m.start())
            for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    found += [(s, e, "hex", s) for s, e in _runs(_HEX[np.frombuffer(text, np.uint8)], 24)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def credential_runs(text: bytes, least: int) -> list[tuple[int, int]]:
    """Maximal runs of credential characters; a single dot between two others belongs to a run."""
    a = np.frombuffer(text, np.uint8)
    inside = _RUN[a]
    dots = np.flatnonzero(a[1:-1] == _DOT) + 1
    joined = inside.copy()
    joined[dots] = inside[dots - 1] & inside[dots + 1]
    return _runs(joined, least)


def _covered(text: bytes, spans: list[tuple[int, int, str, int]]) -> np.ndarray:
    """Before each place: the bytes inside base spans."""
    inside = np.zeros(len(text) + 1, dtype=np.int64)
    for s, e, *_ in spans:
        inside[s + 1 : e + 1] = 1
    return np.cumsum(inside)


def other_runs(text: bytes, spans: list[tuple[int, int, str, int]], least: int) -> list[tuple[int, int]]:
    """Runs of credential characters that no base span touches."""
    runs = credential_runs(text, least)
    if not runs or not spans:
        return runs
    before = _covered(text, spans)
    return [(s, e) for s, e in runs if before[s] == before[e]]


def candidates(text: bytes, spans: list[tuple[int, int, str, int]], least: int) -> list[tuple[int, int]]:
    """Runs of credential characters that base spans leave a part of; they are taken whole."""
    runs = credential_runs(text, least)
    if not runs or not spans:
        return runs
    before = _covered(text, spans)
    return [(s, e) for s, e in runs if before[e] - before[s] < e - s]


# ---- characters as symbols ----

_CLASSES = {
    "0": b"0123456789", "a": b"abcdef", "g": b"ghijklmnopqrstuvwxyz", "A": b"ABCDEF",
    "G": b"GHIJKLMNOPQRSTUVWXYZ",
}
_SYMBOL = {c: (name, -math.log(len(v))) for name, v in _CLASSES.items() for c in v}
END = "$"
SYMBOLS = [*_CLASSES, *"+/_.=-", END]


def symbols(value: bytes) -> tuple[list[str], float]:
    """Class symbols, and the log likelihood of the characters given their classes."""
    got = [_SYMBOL.get(c) or (chr(c), 0.0) for c in value]
    return [s for s, _ in got] + [END], sum(p for _, p in got)


def taught(value: bytes) -> list[str]:
    """The symbols that a value teaches; one longer than ``LEARNED`` bytes is cut and has no end."""
    if len(value) > LEARNED:
        return symbols(value[:LEARNED])[0][:-1]
    return symbols(value)[0]


def _prefixes(sequences: list[list[str]]) -> tuple[dict[int, dict[str, int]], dict[int, Counter]]:
    """Transitions and counts of the prefix tree; sparse nodes of one depth are one state."""
    tree: list[dict[str, int]] = [{}]
    passed = [len(sequences)]
    for sequence in sequences:
        at = 0
        for s in sequence[:DEPTH]:
            if s not in tree[at]:
                tree[at][s] = len(tree)
                tree.append({})
                passed.append(0)
            at = tree[at][s]
            passed[at] += 1
    states: dict[int, dict[str, int]] = {0: {}}
    counts: dict[int, Counter] = {0: Counter()}
    for sequence in sequences:
        at = node = 0
        for depth, s in enumerate(sequence, 1):
            counts[at][s] += 1
            if s == END:
                break
            node = tree[node].get(s) if node is not None and depth < DEPTH else None
            own = node is not None and passed[node] >= EVIDENCE
            after = node if own else -min(depth, DEPTH)
            states[at][s] = after
            states.setdefault(after, {})
            counts.setdefault(after, Counter())
            at = after
    return states, counts


def _differ(a: Counter, b: Counter, bound: float) -> bool:
    """Whether both say enough and their frequencies lie apart."""
    n, m = a.total(), b.total()
    if min(n, m) < EVIDENCE:
        return False
    most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return any(abs(a[s] / n - b[s] / m) > most for s in a.keys() | b.keys())


class _Fold:
    """States joined into one with all that follows; nothing outside is changed until it is kept."""

    def __init__(self, states, counts, bound: float) -> None:
        self.states, self.counts, self.bound = states, counts, bound
        self.into: dict[int, int] = {}
        self.next: dict[int, dict[str, int]] = {}
        self.sums: dict[int, Counter] = {}

    def find(self, x: int) -> int:
        while x in self.into:
            x = self.into[x]
        return x

    def join(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = map(self.find, todo.pop())
            if x == y:
                continue
            left, right = (self.sums.get(z, self.counts[z]) for z in (x, y))
            if _differ(left, right, self.bound):
                return False
            after = dict(self.next.get(x, self.states[x]))
            for s, z in self.next.get(y, self.states[y]).items():
                if s in after:
                    todo.append((after[s], z))
                else:
                    after[s] = z
            self.into[y], self.next[x], self.sums[x] = x, after, left + right
        return True

    def keep(self) -> None:
        self.states.update(self.next)
        self.counts.update(self.sums)
        for gone in self.into:
            del self.states[gone], self.counts[gone]
        for after in self.states.values():
            for s, z in after.items():
                after[s] = self.find(z)


class Automaton:
    """A probabilistic automaton inferred from sequences of symbols; its last state is the sink."""

    def __init__(self, next_: list[dict[str, int]], counts: list[dict[str, int]]) -> None:
        self.next = [*next_, {}]
        self.sink = len(next_)
        self.log = []
        for c in [*counts, {}]:
            total = sum(c.values()) + 0.5 * len(SYMBOLS)
            self.log.append({s: math.log((c.get(s, 0) + 0.5) / total) for s in SYMBOLS})

    @classmethod
    def infer(cls, sequences: list[list[str]], alpha: float = ALPHA) -> Automaton:
        states, counts = _prefixes(sequences)
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        # red states stay; blue ones follow them, and each is merged into a red one or becomes red
        red: dict[int, None] = {}
        blue = deque([0])
        while blue:
            at = blue.popleft()
            if at not in states or at in red:
                continue
            for r in red if counts[at].total() >= EVIDENCE else ():
                if counts[r].total() < EVIDENCE:
                    continue
                fold = _Fold(states, counts, bound)
                if fold.join(r, at):
                    fold.keep()
                    red = {x: None for x in red if x in states}
                    # what follows the red states may have changed
                    blue.extend({z: None for x in red for z in states[x].values() if z not in red})
                    break
            else:
                red[at] = None
                blue.extend(z for _, z in sorted(states[at].items()) if z not in red)
        number = {r: i for i, r in enumerate(red)}
        return cls(
            [{s: number[z] for s, z in states[r].items()} for r in red], [dict(counts[r]) for r in red]
        )

    def score(self, sequence: list[str]) -> float:
        """Natural log likelihood; a symbol never seen in a state leads to the sink for good."""
        at, total = 0, 0.0
        for s in sequence:
            total += self.log[at][s]
            at = self.next[at].get(s, self.sink)
        return total


class Formats:
    """The automata, each with the lowest accepted likelihood a character, and ordinary runs."""

    def __init__(self, values: dict[str, list[bytes]]) -> None:
        self.automata = {}
        ordinary = [taught(v) for v in values.get("ordinary", ())]
        self.ordinary = Automaton.infer(ordinary or [[END]])
        for kind in KINDS[:3]:
            known = values.get(kind, ())
            if len(known) >= EVIDENCE:
                automaton = Automaton.infer([taught(v) for v in known])
                self.automata[kind] = automaton, self._lowest(known)
        self.shortest = min(
            (len(v) for kind in self.automata for v in values[kind]), default=SHORTEST
        )
        self._seen: dict[bytes, bool] = {}

    @staticmethod
    def without(known: list[bytes]) -> list[Automaton]:
        """For each part of the values an automaton learned from the others."""
        return [
            Automaton.infer([taught(v) for i, v in enumerate(known) if i % PARTS != part])
            for part in range(PARTS)
        ]

    @classmethod
    def _lowest(cls, known: list[bytes]) -> float:
        """The lowest per cent of the values' likelihoods, as values not learned from."""
        automata = cls.without(known)
        scores = [cls._mean(automata[i % PARTS], v) for i, v in enumerate(known)]
        return sorted(scores)[len(scores) // 100]

    @staticmethod
    def _mean(automaton: Automaton, value: bytes) -> float:
        sequence, chars = symbols(value)
        return (automaton.score(sequence) + chars) / len(sequence)

    def calibrate(self, labelled: DataFrame, values: dict[str, list[bytes]]) -> None:
        """Take the lowest accepted likelihoods from all ``labelled`` values (kind, value), whole.

        ``values`` are those that were learned from, cut as they were.
        """
        if not self.automata:
            return
        whole = {kind: automaton for kind, (automaton, _) in self.automata.items()}
        parts = {kind: self.without(values[kind]) for kind in whole}
        learned = {kind: {v: i % PARTS for i, v in enumerate(values[kind])} for kind in whole}

        def score(frames):
            for frame in frames:
                means = []
                for kind, value in zip(frame["kind"], map(bytes, frame["value"]), strict=True):
                    part = learned[kind].get(value[: LEARNED + 1])
                    means.append(Formats._mean(whole[kind] if part is None else parts[kind][part], value))
                yield pd.DataFrame({"kind": frame["kind"], "mean": np.array(means, dtype=float)})

        known = labelled.filter(F.col("kind").isin(*whole)).select("kind", "value")
        means = materialize(known.mapInPandas(score, "kind string, mean double"))
        # rows of a partition are numbered in order: places are found from the partitions' counts
        ranked = materialize(means.orderBy("kind", "mean").withColumn("at", F.monotonically_increasing_id()))
        blocks = ranked.groupBy("kind", F.shiftright("at", 33).alias("block")).agg(
            F.count("*").alias("n"), F.min("at").alias("first")
        ).orderBy("kind", "block").collect()
        for kind, automaton in whole.items():
            rank = sum(b.n for b in blocks if b.kind == kind) // 100
            for b in (b for b in blocks if b.kind == kind):
                if rank < b.n:
                    place = ranked.filter((F.col("kind") == kind) & (F.col("at") == b["first"] + rank))
                    self.automata[kind] = automaton, place.first()["mean"]
                    break
                rank -= b.n

    def accepts(self, value: bytes) -> bool:
        got = self._seen.get(value)
        if got is None:
            plain = self._mean(self.ordinary, value) if self.automata else 0.0
            got = any(
                (mean := self._mean(a, value)) >= least and mean > plain
                for a, least in self.automata.values()
            )
            if len(value) <= REMEMBERED and len(self._seen) < 100_000:
                self._seen[value] = got
        return got

    def __getstate__(self):
        return self.__dict__ | {"_seen": {}}


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Automata from the ``sample`` values with the smallest hashes of each kind, of all texts."""

    def found(batches):
        # ordinary runs: those with the smallest hashes
        kept, most = {}, 1 << 64  # hashes from here on are out
        labelled, size = {}, 0

        def rows(kinds):
            return pd.DataFrame(kinds, columns=["kind", "value", "h"])

        for frame in batches:
            for text in as_bytes(frame["text"]):
                spans = base_spans(text)
                for _, end, kind, start in spans:
                    value = text[start:end]
                    if (kind, value) not in labelled:
                        labelled[kind, value] = xxhash.xxh64_intdigest(value) >> 1
                        size += len(value) + 100
                    if size > HELD_BYTES:
                        yield rows([(k, v, h) for (k, v), h in labelled.items()])
                        labelled, size = {}, 0
                for s, e in other_runs(text, spans, SHORTEST):
                    value = text[s:e]
                    h = xxhash.xxh64_intdigest(value) >> 1
                    if h < most:
                        kept[value[: LEARNED + 1]] = h
                        if len(kept) > 4 * sample:
                            least = heapq.nsmallest(sample, kept.items(), lambda x: (x[1], x[0]))
                            kept, most = dict(least), least[-1][1] + 1
        yield rows([(k, v, h) for (k, v), h in labelled.items()])
        yield rows([("ordinary", v, h) for v, h in kept.items()])

    rows = materialize(
        doc_columns(docs).select("text").mapInPandas(found, "kind string, value binary, h long")
        .distinct()
    )
    cut = rows.select("kind", F.substring("value", 1, LEARNED + 1).alias("value"), "h")
    parts = [
        cut.filter(F.col("kind") == k).orderBy("h", "value").limit(sample)
        for k in (*KINDS[:3], "ordinary")
    ]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    values = defaultdict(list)
    for r in sorted(union.collect(), key=lambda r: (r.kind, r.h, bytes(r.value))):
        values[r.kind].append(bytes(r.value))
    formats = Formats(values)
    formats.calibrate(rows, values)
    return formats


def all_spans(text: bytes, formats: Formats) -> list[tuple[int, int, str, int]]:
    spans = base_spans(text)
    more = [
        (s, e, "format", s) for s, e in candidates(text, spans, formats.shortest)
        if formats.accepts(text[s:e])
    ] if formats.automata else []
    return sorted(spans + more, key=lambda x: (x[0], KINDS.index(x[2])))


def _points(text: bytes, spans) -> list[tuple[str, int, int]]:
    """Spans in code points."""
    if not spans or text.isascii():
        return [(k, s, e) for s, e, k, _ in spans]
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    before = np.append(0, np.cumsum(begins))
    return [(k, int(before[s]), int(before[e])) for s, e, k, _ in spans]


def find_secrets(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """doc_id and found: an array of (kind, start, end), by start and then kind, code points."""
    formats = formats or learn(docs)

    def make():
        def of(texts):
            got = [
                [{"kind": k, "start": s, "end": e} for k, s, e in _points(t, all_spans(t, formats))]
                for t in as_bytes(texts)
            ]
            return pd.DataFrame({"found": got})

        return of

    docs = doc_columns(docs)
    kind = "found array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", per_text(make, kind, "text").alias("r")).select("doc_id", "r.found")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""

    def joined(found: Column) -> Column:
        return F.array_join(
            F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        )

    def of(kind: str) -> Column:
        return F.filter("found", lambda x: x["kind"] == kind)

    base = F.filter("found", lambda x: x["kind"] != "format")
    return materialize(find_secrets(docs)).select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def redacted(formats: Formats, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that overlap are replaced as one."""
    sign = mark.encode()

    def make():
        def of(texts):
            out = []
            for original, text in zip(texts, as_bytes(texts), strict=True):
                spans = all_spans(text, formats)
                if not spans:
                    out.append(original)
                    continue
                parts, at = [], 0
                for s, e, *_ in spans:
                    if s >= at:
                        parts += [text[at:s], sign]
                    at = max(at, e)
                out.append(b"".join([*parts, text[at:]]).decode("utf-8", "surrogatepass"))
            return pd.DataFrame({"text": out})

        return of

    return per_text(make, "text string", "text")["text"]
