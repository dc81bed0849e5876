"""Repair of conversation structure by survivor-coalescence Viterbi decoding.

A conversation's rows go by turn (nulls first; ties by role and text). The first fault of a row counts: ``blank``
(no character but white space), ``duplicate`` (role and text seen earlier), ``truncated`` (its
last other character is none of ``.!?``). Edits make the role initials match ``(s?(ua)+)?``:

- ``K`` keeps a row, ``R`` gives it the role user or assistant (cost 2), ``D`` deletes it (3; blank and
  duplicate rows must go), ``I`` inserts an empty user or assistant row (2); a truncated row that stays costs 1.

The cheapest edits are found row by row. Each of the four states of the pattern has one survivor, the
leaf of a tree of back pointers; nodes that no survivor needs any longer go at once, by their reference
counts. Once all survivors share an ancestor, the edits up to it are certain, are carried out, and leave
memory, so what is held is the part still open and not the conversation. Of equally cheap edits
the least in ASCII order is taken: the two open ends are compared whole, back to where they part.
(Two ways to one state after one row are never one the start of the other: the longer would
hold insertions from this state back to itself, which cost more. The choice made is thus final.)

Rows are dealt by conversation and sorted by Spark, and stream through the decoder. A conversation of any length
takes one pass of one task, as its digest is sequential, in bounded memory: duplicates over
different turns are found by a grouping beforehand, those of one turn are neighbours.

A null role or text counts as one space, a null conv_id is a conversation of its own. An empty table
gives no row. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import materialize, part_count, prepare

START, SYSTEM, USER, REPLY = range(4)
_AFTER = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): REPLY, (REPLY, "u"): USER,
}
_NEXT = {START: "u", SYSTEM: "u", USER: "a", REPLY: "u"}  # what a new or changed row must be
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"


class _Node:
    """An edit: its predecessor, its letter, the edits that follow, and the survivors that end here."""

    __slots__ = ("up", "letter", "length", "down", "held")

    def __init__(self, up: _Node | None, letter: str) -> None:
        self.up, self.letter, self.down, self.held = up, letter, [], 0
        self.length = up.length + 1 if up else 0


def _before(a: _Node, b: _Node) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b`` in ASCII order."""
    x, y = [], []
    while a is not b:
        if a.length >= b.length:
            x.append(a.letter)
            a = a.up
        else:
            y.append(b.letter)
            b = b.up
    return x[::-1] < y[::-1]


class Survivors:
    """The cheapest edits into each state, after the rows so far."""

    def __init__(self) -> None:
        self._root = _Node(None, "")
        self._ends: dict[int, tuple[int, _Node]] = {}
        self._hold({START: (0, self._root)})
        self._insert()

    def _hold(self, ends: dict[int, tuple[int, _Node]]) -> None:
        """Make ``ends`` the survivors, and free what only the former ones needed."""
        former, self._ends = self._ends, ends
        for _, node in ends.values():
            node.held += 1
            if node.up and node not in node.up.down:
                node.up.down.append(node)
        for _, node in former.values():
            node.held -= 1
            while node is not self._root and not node.held and not node.down:
                node.up.down.remove(node)
                node = node.up

    def _offer(self, ends: dict, state: int, cost: int, up: _Node, letter: str) -> None:
        known = ends.get(state)
        if known is None or cost <= known[0]:
            node = _Node(up, letter)
            if known is None or cost < known[0] or _before(node, known[1]):
                ends[state] = (cost, node)

    def _insert(self) -> None:
        """Rows inserted at this place; a third one in a row never pays."""
        for states in ((START, SYSTEM, REPLY), (USER,)):
            ends = dict(self._ends)
            for state in states:
                if state in self._ends:
                    cost, node = self._ends[state]
                    self._offer(ends, _AFTER[state, _NEXT[state]], cost + INSERT, node, "I")
            self._hold(ends)

    def step(self, initial: str, lost: bool, cut: bool) -> str:
        """Take a row, which must go if ``lost``; the letters that are certain now."""
        ends: dict[int, tuple[int, _Node]] = {}
        for state, (cost, node) in self._ends.items():
            self._offer(ends, state, cost + DELETE, node, "D")
            if lost:
                continue
            if (state, initial) in _AFTER:
                self._offer(ends, _AFTER[state, initial], cost + CUT * cut, node, "K")
            self._offer(ends, _AFTER[state, _NEXT[state]], cost + REROLE + CUT * cut, node, "R")
        self._hold(ends)
        self._insert()
        self._drop_beaten()
        return self._certain()

    def _drop_beaten(self) -> None:
        """Give up states that the end of an exchange beats, whatever rows follow.

        All that can follow a leading system row can follow an exchange, at the same cost. From the start
        a system row may also be kept; after an exchange it is deleted instead, for ``DELETE`` more.
        """
        if REPLY in self._ends:
            bar = self._ends[REPLY][0]
            ends = {
                s: e for s, e in self._ends.items()
                if not (s == SYSTEM and e[0] > bar or s == START and e[0] > bar + DELETE)
            }
            if len(ends) < len(self._ends):
                self._hold(ends)

    def finish(self) -> tuple[int, str]:
        """The cost of the cheapest edits and their last letters."""
        end = self._ends.get(REPLY)
        start = self._ends.get(START)
        if end is None or start and (
            start[0] < end[0] or start[0] == end[0] and _before(start[1], end[1])
        ):
            end = start
        self._hold({REPLY: end})
        return end[0], self._certain()

    def _certain(self) -> str:
        out = []
        root = self._root
        while not root.held and len(root.down) == 1:
            root = root.down[0]
            root.up = None
            out.append(root.letter)
        self._root = root
        return "".join(out)

    def open_nodes(self) -> int:
        """Edits in memory."""
        count, stack = 0, list(self._root.down)
        while stack:
            node = stack.pop()
            count += 1
            stack += node.down
        return count


class Repair:
    """One conversation: its faults, and its rows as far as their edits are certain."""

    def __init__(self) -> None:
        self._survivors = Survivors()
        self._waiting: deque[tuple] = deque()
        self._state, self._known = START, None
        self._least = self._last_turn = None
        self._turns = 0
        self._digest, self._position = hashlib.sha256(), 0
        self._audit: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def take(self, turn: int | None, role: str, text: str, repeated: bool) -> list[tuple]:
        """Repaired rows (position, turn, role, text, edit) that are certain after this row."""
        shown = text.strip(_BLANKS)
        row = (turn, role, text)
        initial = role[:1]
        if self._known is not None and (self._known[1][:1], initial) not in _LEGAL:
            self.counts["illegal"] += 1
        fault = (
            "blank" if not shown
            else "duplicate" if repeated or row == self._known
            else "truncated" if shown[-1] not in ".!?" else None
        )
        if fault:
            self.counts[fault] += 1
        self._known = row
        if turn is not None and turn != self._last_turn:
            self._least = turn if self._least is None else self._least
            self._last_turn = turn
            self._turns += 1
        self._waiting.append(row)
        lost = fault in ("blank", "duplicate")
        return self._carry_out(self._survivors.step(initial, lost, fault == "truncated"))

    def _carry_out(self, letters: str) -> list[tuple]:
        out = []
        for letter in letters:
            self._audit.append(letter)
            turn, role, text = (None, "", "") if letter == "I" else self._waiting.popleft()
            if letter == "D":
                continue
            initial = role[:1] if letter == "K" else _NEXT[self._state]
            if letter != "K":
                role = _ROLES[initial]
            self._state = _AFTER[self._state, initial]
            line = f"{role}:{text}" if not self._position else f"\n{role}:{text}"
            self._digest.update(line.encode("utf-8", "surrogatepass"))
            out.append((self._position, turn, role, text, letter))
            self._position += 1
        return out

    def finish(self) -> tuple[dict, list[tuple]]:
        """The report and the last repaired rows."""
        cost, letters = self._survivors.finish()
        rows = self._carry_out(letters)
        gaps = self._last_turn - self._least + 1 - self._turns if self._turns else 0
        return {
            "gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self._audit),
            "repaired_sha256": self._digest.hexdigest(),
        }, rows


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
_ROWS = "conv_id long, position long, turn long, role string, text string, edit string"
#: Rows of an output batch.
_BATCH = 1000


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


def _repaired(batches: Iterator[pa.RecordBatch], reports: bool) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_REPORT if reports else _ROWS)
    out: list[tuple] = []
    known, repair = None, None

    def finish():
        told, rows = repair.finish()
        if reports:
            out.append((known[0], *told.values()))
        else:
            out.extend((known[0], *r) for r in rows)

    def batch():
        columns = zip(*out, strict=True)
        made = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(made, schema=schema)

    names = ("conv_id", "turn", "role", "text", "gone", "repeated")
    for frame in batches:
        for conv, turn, role, text, gone, repeated in zip(
            *(frame.column(n).to_pylist() for n in names), strict=True
        ):
            if known != (conv,):
                if repair:
                    finish()
                known, repair = (conv,), Repair()
            if not gone:
                rows = repair.take(turn, role, text, bool(repeated))
                if not reports:
                    out.extend((conv, *r) for r in rows)
            if len(out) >= _BATCH:
                yield batch()
    if repair:
        finish()
    if out:
        yield batch()


def plain_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, nulls of the latter two as one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        F.lit(False).alias("gone"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the stated damage, chosen by the crc32 of conversation and turn.

    A dropped row stays as a mark (``gone``), so that its conversation is still known.
    """
    rows = plain_rows(conversations)
    key = F.concat_ws(":", *(
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")
    ))
    fault = F.crc32(key) % 20
    text = (
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (fault == 0).alias("gone"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _same() -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))


def _stream(rows: DataFrame, reports: bool) -> DataFrame:
    spark = prepare(rows.sparkSession)
    keyed = rows.withColumn("h", _same())
    turn = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    conv = [F.col("conv_id").isNull().alias("n"), F.coalesce("conv_id", F.lit(0)).alias("c")]
    # written first: a join plans by its size
    firsts = materialize(
        keyed.filter("NOT gone").groupBy(*conv, "h")
        .agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
        .filter("first < last").drop("last")
    )
    told = keyed.select("*", *conv).join(firsts, ["n", "c", "h"], "left").select(
        "n", "c", "conv_id", "turn", "role", "text", "gone", (turn > F.col("first")).alias("repeated")
    )
    sorted_rows = told.repartition(part_count(spark), "n", "c").sortWithinPartitions(
        "n", "c", F.asc_nulls_first("turn"), "role", "text", "gone"
    ).drop("n", "c")
    return sorted_rows.mapInArrow(
        lambda batches: _repaired(batches, reports), _REPORT if reports else _ROWS
    )


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position, turn (null if inserted), role, text and edit (K, R, I)."""
    return _stream(plain_rows(conversations), False)


def audits(conversations: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost and letters of its edits, and the repaired rows' digest."""
    return _stream(plain_rows(conversations), True)


def report(conversations: DataFrame) -> DataFrame:
    """:func:`audits` of conversations after :func:`damaged`."""
    return _stream(damaged(conversations), True)
