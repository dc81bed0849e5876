"""Conversation repair against all edit sequences of small conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tarnkeep.llm import common, repair

SCHEMA = "conv_id long, turn long, role string, text string, c string, h string, first string, gone string"
PATTERN = re.compile("(s?(ua)+)?")
SHOWN = re.compile("[^\x20\x09-\x0d]")


def make(spark, rows):
    return common.prepare(spark).createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = SHOWN.findall(text)
        out.append(
            "blank" if not shown else "duplicate" if (role, text) in seen
            else "truncated" if shown[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def every_way(rows):
    """(cost, audit, repaired rows) of the cheapest edits, found by trying all."""
    faults = faults_of(rows)
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    per_row = []
    for (role, text), fault in zip(rows, faults, strict=True):
        more = fault == "truncated"
        ways = [(3, "D", ())]
        if fault not in ("blank", "duplicate"):
            ways.append((more, "K", ((role, text),)))
            ways += [(2 + more, "R", ((new, text),)) for new in ("user", "assistant")]
        per_row.append(ways)
    for between in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*per_row):
            cost = sum(e[0] for e in edits) + 2 * sum(map(len, between))
            if best and cost > best[0]:
                continue
            out = [(role, "") for role in between[0]]
            audit = "I" * len(between[0])
            for (_, letter, kept), gap in zip(edits, between[1:], strict=True):
                out += [*kept, *((role, "") for role in gap)]
                audit += letter + "I" * len(gap)
            if PATTERN.fullmatch("".join(role[:1] or "-" for role, _ in out)):
                best = min(best, (cost, audit, out)) if best else (cost, audit, out)
    return best


def by_states(rows):
    """(cost, audit) by keeping whole strings per state: no tree, for longer conversations."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "")}

    def with_insertions(found):
        for _ in range(3):
            for (state, role), new in after.items():
                if role != "s" and state in found:
                    cost, audit = found[state]
                    found[new] = min(found.get(new, (1 << 60, "")), (cost + 2, audit + "I"))
        return found

    best = with_insertions(best)
    for (role, _), fault in zip(rows, faults_of(rows), strict=True):
        found = {}
        for state, (cost, audit) in best.items():
            ways = [(state, cost + 3, "D")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                ways += [(after[state, role[:1]], cost + more, "K")] if (state, role[:1]) in after else []
                ways += [(after[state, r], cost + 2 + more, "R") for r in "ua" if (state, r) in after]
            for new, c, letter in ways:
                found[new] = min(found.get(new, (1 << 60, "")), (c, audit + letter))
        best = with_insertions(found)
    return min(best[s] for s in ("", "a") if s in best)


def run(rows):
    one, out, seen = repair.Repair(), [], set()
    for turn, (role, text) in enumerate(rows):
        out += one.take(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    told, rest = one.finish()
    return told, [(role, text) for _, _, role, text, _ in out + rest]


ROLES = ["user", "assistant", "system", "tool", "usr", "", " "]
TEXTS = ["Yes.", "No", " ", "", "Why?", "A.\n", "b! c"]


def test_cheapest_edits_equal_trying_all():
    rng = random.Random(11)
    for n in (0, 1, 1, 2, 2, *[3] * 25):
        rows = [(rng.choice(ROLES[:5]), rng.choice(TEXTS)) for _ in range(n)]
        told, out = run(rows)
        cost, audit, want = every_way(rows)
        assert (told["cost"], told["audit"], out) == (cost, audit, want), rows
        text = "\n".join(f"{r}:{t}" for r, t in want)
        assert told["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_longer_conversations_and_ties():
    rng = random.Random(12)
    for _ in range(400):
        roles = rng.choice([["user"], ["user", "assistant"], ROLES])
        rows = [(rng.choice(roles), f"{rng.choice(TEXTS)}{i}." if rng.random() < 0.8 else rng.choice(TEXTS))
                for i in range(rng.randint(4, 60))]
        told, _ = run(rows)
        assert (told["cost"], told["audit"]) == by_states(rows), rows


def test_memory_follows_what_is_open():
    rng = random.Random(13)
    survivors, most, told = repair.Survivors(), 0, 0
    for _ in range(20000):
        told += len(survivors.step(rng.choice("ssuuaat"), rng.random() < 0.1, rng.random() < 0.1))
        most = max(most, survivors.open_nodes())
    assert most < 60 and told > 19900


def expected(rows):
    """The report by conv_id, from the contract."""
    out = {}
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        name = [" " if x is None else str(x) for x in (conv, turn)]
        fault = zlib.crc32(":".join(name).encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        if fault:
            kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in kept if t is not None}
        plain = [(r, t) for _, r, t in kept]
        faults = faults_of(plain)
        cost, audit = by_states(plain)
        pairs = zip(plain, plain[1:])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in pairs),
            cost, audit,
        )
    return out


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(14)
    rows = []
    for conv in [*range(80), None, -3]:
        for turn in range(rng.randint(1, 9)):
            rows.append((
                conv, rng.choice([turn, turn, turn, None, 40]), rng.choice([*ROLES, None, "user", "assistant"]),
                rng.choice([*TEXTS, None, "x" * 9000, f"text {turn}."]),
            ))
    rows += [(7, 3, "user", "Yes."), (7, 3, "user", "Yes."), (7, 5, "user", "Yes."), (500, 1, "user", None)]
    return rows


def test_report_of_a_table(spark, conversations):
    got = repair.report(make(spark, conversations).repartition(5)).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == expected(conversations)
    assert len(got) == len({r[0] for r in conversations})
    gone = [r for r in got if not r.audit and not r.cost]
    assert all(r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in gone)


def test_repaired_rows_give_the_digests(spark, conversations):
    docs = make(spark, conversations)
    rows = defaultdict(list)
    for r in repair.repaired(docs).collect():
        rows[r.conv_id].append((r.position, r.role, r.text, r.edit, r.turn))
    for r in repair.audits(docs).collect():
        lines = sorted(rows[r.conv_id])
        assert [x[0] for x in lines] == list(range(len(lines)))
        assert PATTERN.fullmatch("".join(x[1][0] for x in lines))
        text = "\n".join(f"{x[1]}:{x[2]}" for x in lines)
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert "".join(x[3] for x in lines) == r.audit.replace("D", "")
        assert all(x[4] is None for x in lines if x[3] == "I")


def test_empty_table(spark):
    empty = make(spark, [])
    assert repair.report(empty).collect() == [] and repair.repaired(empty).collect() == []
