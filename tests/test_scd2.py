from datetime import date

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import pytest

import plans
from tarnkeep.operators.scd2 import (
    current_rows, record_hash, scd2_advance, scd2_apply, scd2_changes, scd2_counts, scd2_rejects,
    scd2_stage,
)
from tarnkeep.plans.jobs import load_history
from tarnkeep.session import scratch_dir
from tarnkeep.sinks.history import HistoryFolder, HistoryTable
from tarnkeep.sinks.tables import ensure_schema

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, a string, b string")


def stage(df, day, **options):
    return scd2_stage(df, ["k"], ["a", "b"], day, **options)


def versions(history):
    return sorted(
        (r.k, str(r.a), str(r.effective_start_date), str(r.effective_end_date), r.current_flag)
        for r in history.collect()
    )


def test_kept_closed_new_and_missing(spark):
    history = scd2_apply(None, stage(rows(spark, (1, "x", None), (2, "y", None), (3, "z", None)), DAYS[0]), ["k"])
    staged = stage(rows(spark, (1, "x", None), (2, "Y", None), (4, "w", None)), DAYS[1])
    assert versions(scd2_apply(history, staged, ["k"], DAYS[1])) == [
        (1, "x", DAYS[0], "None", True),
        (2, "Y", DAYS[1], "None", True),
        (2, "y", DAYS[0], DAYS[1], False),
        (3, "z", DAYS[0], "None", True),
        (4, "w", DAYS[1], "None", True),
    ]
    closing = scd2_apply(history, staged, ["k"], DAYS[1], close_missing=True)
    assert (3, "z", DAYS[0], DAYS[1], False) in versions(closing)
    assert {r.k for r in scd2_changes(history, staged, ["k"]).collect()} == {2, 4}
    assert tuple(scd2_counts(closing).first()) == (3, 5)


def test_stage_keeps_one_row_per_key_and_rejects_null_keys(spark):
    df = rows(spark, (1, "b", None), (1, "a", None), (None, "c", None))
    staged = stage(df, DAYS[0]).collect()
    assert [(r.k, r.a) for r in staged] == [(1, "a")]
    assert [r.a for r in scd2_rejects(df, ["k"]).collect()] == ["c"]


def test_hash_and_nulls(spark):
    df = rows(spark, (1, None, "A"), (1, "A", None))
    plain = [r[0] for r in df.select(record_hash(["k", "a", "b"])).collect()]
    marked = [r[0] for r in df.select(record_hash(["k", "a", "b"], "\x00")).collect()]
    assert plain[0] == plain[1] and marked[0] != marked[1]
    assert spark.sql("select md5('1||A') h").first()[0] == plain[0]


load = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.sampled_from([None, "x", "y"]), st.just(None)),
    max_size=5,
)


@settings(max_examples=6, deadline=None, derandomize=True, database=None,
          phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(load, min_size=1, max_size=3))
def test_histories_are_sound(spark, loads):
    history = None
    for day, values in zip(DAYS, loads):
        staged = stage(rows(spark, *values), day, null_token="-")
        once = scd2_apply(history, staged, ["k"], day)
        twice = scd2_apply(once, staged, ["k"], day)
        assert versions(once) == versions(twice)
        history = spark.createDataFrame(once.collect(), once.schema)
    by_key = {}
    for k, _, start, end, current in versions(history):
        assert current == (end == "None")
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        assert sum(end == "None" for _, end in spans) == 1
        spans.sort()
        assert all(end == start for (_, end), (start, _) in zip(spans, spans[1:]))


def test_one_join_and_two_exchanges(spark):
    write_table_path = scratch_dir(spark)
    stage(rows(spark, (1, "x", None)), DAYS[0]).write.parquet(write_table_path)
    saved = spark.read.parquet(write_table_path)
    with plans.without_broadcast(spark):
        advanced = scd2_advance(current_rows(saved), saved, ["k"], DAYS[1])
        assert plans.count(advanced, "SortMergeJoin") == 1
        assert plans.count(advanced, "Exchange") == 2


@pytest.fixture(params=["folder", "table"])
def store(spark, request):
    if request.param == "folder":
        return HistoryFolder(scratch_dir(spark))
    location = scratch_dir(spark)
    schema = "history_" + location.rsplit("-", 1)[1]
    ensure_schema(spark, schema, location)
    return HistoryTable(f"{schema}.kept", ["k"], 4)


def test_runs(spark, store):
    def arrive(day, *values, **options):
        return load_history(spark, rows(spark, *values), store, ["k"], ["a", "b"], day, **options)

    assert store.last_run(spark) == 0
    assert arrive(DAYS[0], (1, "x", None), (2, "y", None)) == 1
    assert arrive(DAYS[1], (1, "x", None), (2, "y", None)) == 1
    assert arrive(DAYS[1], (1, "X", None)) == 2
    assert arrive(DAYS[2], (1, "X", "moved"), (3, "z", None)) == 3
    assert versions(store.history(spark)) == [
        (1, "X", DAYS[1], DAYS[2], False),
        (1, "X", DAYS[2], "None", True),
        (1, "x", DAYS[0], DAYS[1], False),
        (2, "y", DAYS[0], "None", True),
        (3, "z", DAYS[2], "None", True),
    ]
    assert versions(store.history(spark, 1)) == [
        (1, "x", DAYS[0], "None", True), (2, "y", DAYS[0], "None", True),
    ]
    assert store.current(spark).count() == 3
    assert arrive(DAYS[3], (1, "X", "moved"), close_missing=True) == 4
    assert store.current(spark).count() == 1
    assert set(store.current(spark).columns) == set(store.history(spark).columns)


def test_only_current_files_are_opened(spark):
    store = HistoryFolder(scratch_dir(spark))
    for day, value in zip(DAYS, "abc"):
        load_history(spark, rows(spark, (1, value, None)), store, ["k"], ["a", "b"], day)
    opened = store.current(spark).inputFiles()
    assert opened and all("run=3" in f for f in opened)
    assert "PartitionFilters: [isnotnull(state" in plans.physical(store.current(spark))


def test_bucketed_runs_are_joined_without_a_shuffle(spark):
    location = scratch_dir(spark)
    ensure_schema(spark, "unshuffled", location)
    store = HistoryTable("unshuffled.kept", ["k"], 4)
    store.write_run(stage(rows(spark, *[(i, "x", None) for i in range(50)]), DAYS[0]), 1)
    staged = store.stage(stage(rows(spark, *[(i, "y", None) for i in range(60)]), DAYS[1]))
    with plans.without_broadcast(spark):
        for joined in (
            scd2_changes(store.current(spark), staged, ["k"]),
            scd2_advance(store.current(spark), staged, ["k"], DAYS[1]),
        ):
            assert plans.count(joined, "Exchange") == 0
            assert plans.count(joined, "SortMergeJoin") == 1
    store.write_run(scd2_advance(store.current(spark), staged, ["k"], DAYS[1]), 2)
    assert len(store.current(spark, 2).inputFiles()) <= 2 * 4
    assert (store.current(spark).count(), store.history(spark).count()) == (60, 110)


def test_run_without_marker_does_not_count(spark):
    store = HistoryFolder(scratch_dir(spark))
    load_history(spark, rows(spark, (1, "x", None)), store, ["k"], ["a", "b"], DAYS[0])
    broken = stage(rows(spark, (9, "q", None)), DAYS[1])
    with plans.settings(spark, mapreduce__fileoutputcommitter__marksuccessfuljobs="false"):
        store.write_run(broken, 2)
    assert store.last_run(spark) == 1
    assert store.history(spark).count() == 1
    load_history(spark, rows(spark, (1, "y", None)), store, ["k"], ["a", "b"], DAYS[1])
    assert store.last_run(spark) == 2
    assert {r.k for r in store.history(spark).collect()} == {1}


def test_rejects_are_kept(spark):
    store, rejects = HistoryFolder(scratch_dir(spark)), scratch_dir(spark)
    load_history(
        spark, rows(spark, (1, "x", None), (None, "lost", None)), store, ["k"], ["a", "b"],
        date(2024, 1, 1), rejects_path=rejects,
    )
    assert [r.a for r in spark.read.parquet(rejects).collect()] == ["lost"]


def test_a_load_dated_before_the_current_version_fails(spark):
    history = scd2_apply(None, stage(rows(spark, (1, "x", None), (2, "y", None)), DAYS[2]), ["k"])
    same = stage(rows(spark, (1, "x", None)), DAYS[0])
    assert len(versions(scd2_apply(history, same, ["k"], DAYS[0]))) == 2
    changed = stage(rows(spark, (1, "X", None)), DAYS[0])
    with pytest.raises(Exception, match="dated before"):
        scd2_apply(history, changed, ["k"], DAYS[0]).collect()
