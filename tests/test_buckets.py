"""Histories in key buckets: what a load rewrites, late rows, several versions at once, commits."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import plans
from tarnkeep.operators.scd2 import scd2_apply, scd2_stage
from tarnkeep.plans.jobs import load_history
from tarnkeep.session import scratch_dir
from tarnkeep.sinks import buckets
from tarnkeep.sinks.buckets import BUCKET, PART, KeyBuckets

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
FIRST = date(2024, 1, 1)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, a string, day date")


def arrive(spark, store, day, *values, **options):
    return load_history(spark, rows(spark, *values), store, ["k"], ["a"], day, **options)


def versions(history):
    return sorted(
        (r.k, str(r.a), str(r.effective_start_date), str(r.effective_end_date), r.current_flag)
        for r in history.collect()
    )


@pytest.fixture
def store(spark):
    return KeyBuckets(scratch_dir(spark), ["k"], 4)


def test_loads_in_order(spark, store):
    assert store.last_run(spark) == 0
    with pytest.raises(ValueError, match="no committed load"):
        store.history(spark)
    assert arrive(spark, store, DAYS[0], (1, "x", None), (2, "y", None)) == 1
    assert arrive(spark, store, DAYS[1], (1, "x", None), (2, "y", None)) == 1
    assert arrive(spark, store, DAYS[1], (1, "X", None)) == 2
    assert arrive(spark, store, DAYS[2], (1, "Z", None), (3, "z", None)) == 3
    assert versions(store.history(spark)) == [
        (1, "X", DAYS[1], DAYS[2], False), (1, "Z", DAYS[2], "None", True), (1, "x", DAYS[0], DAYS[1], False),
        (2, "y", DAYS[0], "None", True), (3, "z", DAYS[2], "None", True),
    ]
    assert versions(store.history(spark, 1)) == [(1, "x", DAYS[0], "None", True), (2, "y", DAYS[0], "None", True)]
    assert store.current(spark).count() == 3 and store.counts(spark) == (3, 5)
    assert store.history(spark).columns == store.current(spark).columns


def test_one_changed_key_rewrites_one_bucket(spark):
    store = KeyBuckets(scratch_dir(spark), ["k"], 64)
    keys = spark.range(10_000).selectExpr("cast(id as int) k", "'a' a", "cast(null as date) day")
    load = lambda df, day: load_history(spark, df, store, ["k"], ["a"], day)
    load(keys, DAYS[0])
    assert len(store.manifest(spark).written) == 64
    # a whole snapshot that differs in one key, and one row alone
    load(keys.selectExpr("k", "if(k = 77, 'b', a) a", "day"), DAYS[1])
    assert len(store.manifest(spark).written) == 1
    load(rows(spark, (77, "c", None)), DAYS[2])
    assert len(store.manifest(spark).written) == 1 and store.counts(spark) == (10_000, 10_002)
    folders = spark.read.parquet(f"{store.path}/run=3").select(PART, BUCKET).distinct().collect()
    assert sorted(f[PART] for f in folders) == ["current", "past"] and len({f[BUCKET] for f in folders}) == 1


def test_only_touched_buckets_are_read(spark):
    store = KeyBuckets(scratch_dir(spark), ["k"], 64)
    keys = spark.range(1000).selectExpr("cast(id as int) k", "'a' a", "cast(null as date) day")
    load_history(spark, keys, store, ["k"], ["a"], DAYS[0])
    manifest = store.manifest(spark)
    opened = store._read(spark, manifest, [], [5]).inputFiles()
    assert opened and all(f"{BUCKET}=5/" in f and f"{PART}=current" in f for f in opened)


def test_one_shuffle_and_no_join(spark, store, monkeypatch):
    seen = []
    original = buckets.splice

    def spy(*args):
        out = original(*args)
        seen.append((plans.count(out, "Exchange"), plans.count(out, "Join")))
        return out

    monkeypatch.setattr(buckets, "splice", spy)
    arrive(spark, store, DAYS[0], (1, "x", None))
    arrive(spark, store, DAYS[1], (1, "y", None), (2, "x", None))
    assert seen == [(1, 0), (1, 0)]


def test_late_rows_split_versions(spark, store):
    arrive(spark, store, DAYS[0], (1, "a", None), (2, "q", None))
    arrive(spark, store, DAYS[3], (1, "d", None))
    assert arrive(spark, store, DAYS[1], (1, "b", None)) == 3
    assert versions(store.history(spark))[:3] == [
        (1, "a", DAYS[0], DAYS[1], False), (1, "b", DAYS[1], DAYS[3], False), (1, "d", DAYS[3], "None", True),
    ]
    # before the first version, and equal to what follows
    arrive(spark, store, "2023-12-01", (1, "a", None), (2, "old", None))
    assert versions(store.history(spark)) == [
        (1, "a", "2023-12-01", DAYS[1], False), (1, "b", DAYS[1], DAYS[3], False),
        (1, "d", DAYS[3], "None", True), (2, "old", "2023-12-01", DAYS[0], False), (2, "q", DAYS[0], "None", True),
    ]
    assert store.counts(spark) == (2, 5)
    assert versions(store.history(spark, 2)) == [
        (1, "a", DAYS[0], DAYS[3], False), (1, "d", DAYS[3], "None", True), (2, "q", DAYS[0], "None", True),
    ]


def test_several_versions_of_a_key_in_one_load(spark, store):
    day = lambda n: FIRST + timedelta(n)
    values = [(1, "c", day(2)), (1, "a", day(0)), (1, "a", day(1)), (2, "x", None), (1, "b", day(3)), (1, "b", day(3))]
    arrive(spark, store, DAYS[0], *values, dated_by="day")
    assert versions(store.history(spark)) == [
        (1, "a", DAYS[0], DAYS[2], False), (1, "b", DAYS[3], "None", True), (1, "c", DAYS[2], DAYS[3], False),
        (2, "x", DAYS[0], "None", True),
    ]


def test_missing_keys(spark, store):
    arrive(spark, store, DAYS[0], (1, "a", None), (2, "b", None))
    arrive(spark, store, DAYS[1], (1, "a", None), close_missing=True)
    assert versions(store.current(spark)) == [(1, "a", DAYS[0], "None", True)]
    assert arrive(spark, store, DAYS[2], (1, "a", None), close_missing=True) == 2
    # the key comes back as it was: a new version
    arrive(spark, store, DAYS[3], (2, "b", None))
    assert versions(store.history(spark)) == [
        (1, "a", DAYS[0], "None", True), (2, "b", DAYS[0], DAYS[1], False), (2, "b", DAYS[3], "None", True),
    ]
    arrive(spark, store, "2024-01-05", close_missing=True)
    assert store.current(spark).collect() == [] and store.counts(spark) == (0, 3)


statement = st.tuples(st.integers(1, 3), st.sampled_from("ab"), st.integers(0, 8))


@settings(max_examples=10, deadline=None, derandomize=True, database=None,
          phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(statement, min_size=1, max_size=14, unique_by=lambda s: (s[0], s[2])), st.randoms())
def test_any_order_of_loads_gives_one_history(spark, statements, rng):
    want = []
    for key in {k for k, _, _ in statements}:
        chain = []
        for _, value, day in sorted((k, v, d) for k, v, d in statements if k == key):
            chain.append((day, value))
        chain.sort()
        starts = [c for i, c in enumerate(chain) if not i or chain[i - 1][1] != c[1]]
        for i, (day, value) in enumerate(starts):
            end = str(FIRST + timedelta(starts[i + 1][0])) if i + 1 < len(starts) else "None"
            want.append((key, value, str(FIRST + timedelta(day)), end, end == "None"))
    rng.shuffle(statements)
    store = KeyBuckets(scratch_dir(spark), ["k"], 2)
    cut = rng.randint(0, len(statements))
    for part in (statements[:cut], statements[cut:]):
        values = [(k, v, FIRST + timedelta(d)) for k, v, d in part]
        if values:
            arrive(spark, store, DAYS[0], *values, dated_by="day", confirm=True)
    assert versions(store.history(spark)) == sorted(want)


def test_equal_to_the_joined_form(spark, store):
    stage = lambda df, day: scd2_stage(df, ["k"], ["a"], day)
    first = [(i, "a", None) for i in range(20)]
    second = [(i, "a" if i % 3 else "b", None) for i in range(5, 25)]
    for missing in (False, True):
        store = KeyBuckets(scratch_dir(spark), ["k"], 4)
        arrive(spark, store, DAYS[0], *first)
        arrive(spark, store, DAYS[1], *second, close_missing=missing)
        joined = scd2_apply(
            stage(rows(spark, *first), DAYS[0]), stage(rows(spark, *second), DAYS[1]), ["k"], DAYS[1], missing
        )
        assert versions(store.history(spark)) == versions(joined)


def test_a_load_that_fails_before_its_commit_does_not_count(spark, store, monkeypatch):
    arrive(spark, store, DAYS[0], (1, "x", None))
    with monkeypatch.context() as patch:
        patch.setattr(KeyBuckets, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            arrive(spark, store, DAYS[1], (1, "y", None), (9, "q", None))
    assert versions(store.history(spark)) == [(1, "x", DAYS[0], "None", True)]
    assert arrive(spark, store, DAYS[1], (1, "z", None)) == 2
    assert [v[1] for v in versions(store.history(spark))] == ["x", "z"]


def test_two_loads_at_once_cannot_both_commit(spark, store):
    arrive(spark, store, DAYS[0], (1, "x", None))
    manifest = store.manifest(spark)
    with pytest.raises(RuntimeError, match="another load"):
        store._commit(spark, manifest)


def test_many_past_parts_are_merged_and_old_folders_go(spark, monkeypatch):
    monkeypatch.setattr(buckets, "MERGE_AT", 3)
    store = KeyBuckets(scratch_dir(spark), ["k"], 1)
    for n in range(7):
        arrive(spark, store, str(FIRST + timedelta(n)), (1, f"v{n}", None))
    want = versions(store.history(spark))
    assert len(want) == 7 and len(store.manifest(spark).buckets[0].past) <= 3
    assert store.vacuum(spark) > 0
    assert versions(store.history(spark)) == want and store.last_run(spark) == 7
    arrive(spark, store, "2024-02-01", (1, "w", None))
    assert len(versions(store.history(spark))) == 8


def test_other_columns_or_buckets_are_refused(spark, store):
    arrive(spark, store, DAYS[0], (1, "x", None))
    with pytest.raises(ValueError, match="in 4 buckets"):
        KeyBuckets(store.path, ["k"], 8).current(spark)
    with pytest.raises(ValueError, match="holds"):
        load_history(spark, rows(spark, (1, "x", None)), store, ["k"], ["a", "day"], DAYS[1])
