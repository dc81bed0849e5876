"""The conversation trie against one built in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tarnkeep.llm import common, tour

SCHEMA = "conv_id long, turn long, role string, text string, c string, d string, k1 string, p string"


def make(spark, rows):
    return common.prepare(spark).createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(found, key=lambda r: r[:2])] for c, found in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = {}

    def leaves_and_savings(node):
        own_saving = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        found = [leaves_and_savings(child) for child in children[node]]
        leaves = sum(x for x, _ in found) if found else 1
        saved = own_saving + sum(x for _, x in found)
        text = ",".join(map(str, sorted(ends[node])))
        out[min(members[node]), len(node)] = (
            min(members[node[:-1]]) if node else None, len(members[node]), len(found), leaves, saved,
            hashlib.sha256(text.encode()).hexdigest(),
        )
        return leaves, saved

    if whole:
        leaves_and_savings(())
    return out


NAMES = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def check(spark, rows):
    got = tour.report(make(spark, rows).repartition(5)).collect()
    assert {(r.conv_id, r.depth): tuple(r[n] for n in NAMES) for r in got} == expected(rows)
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    # the tour visits every arc once, and a child's arcs lie between its parent's
    arcs = [x for r in got for x in (r.enter_at, r.exit_at)]
    assert sorted(arcs) == list(range(2 * len(got)))
    place = {(r.conv_id, r.depth): r for r in got}
    for r in got:
        if r.parent_conv_id is not None:
            up = place[r.parent_conv_id, r.depth - 1]
            assert up.enter_at < r.enter_at < r.exit_at < up.exit_at


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    out = []
    # families with and without a base, and bases of few turns
    for conv in [*range(0, 30), *range(100, 130), *range(201, 215), *range(300, 305), 1000, 70000]:
        n = rng.randint(1, 4) if conv % 100 == 0 else rng.randint(1, 9)
        for turn in range(n):
            role = rng.choice(["user", "assistant", None, ""])
            text = rng.choice(["same", "sämé", None, "", f"t{rng.randint(0, 3)}"])
            out.append((conv, turn if turn else None, role, "hello" if turn == 0 else text))
    out += [(None, 1, "user", "no conversation"), (77777, 1, "user", "hello")]
    out += [(500, i, "user", "long" * 500 if i == 9 else "x") for i in range(60)]
    out += [(501, 2, "user", "y"), (501, 2, "user", "y"), (501, 2, "user", "y")]
    return out


@pytest.mark.parametrize("parts", ["4", "23"])
def test_trie_equals_brute_force(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_numbers_far_from_the_tour(spark):
    """Families that share nothing with their neighbours, but with far ones: many fragments."""
    rng = random.Random(22)
    rows = []
    for i in range(120):
        seed = random.Random(rng.randint(0, 6))
        for turn in range(rng.randint(1, 12)):
            rows.append((i * 100, turn, "user", f"{seed.randint(0, 2)}"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_small_and_empty_tables(spark):
    assert tour.report(make(spark, [])).collect() == []
    assert tour.report(make(spark, [(None, 1, "user", "x")])).collect() == []
    check(spark, [(7, 0, "user", "a")])
    check(spark, [(c, 0, "user", "all the same") for c in range(300)])
