"""Mergeable states: equal to full runs, and only what changed is read."""

import random

import pytest

from tarnkeep.operators import quality, states
from tarnkeep.operators.profiling import profile
from tarnkeep.operators.states import PART_OF
from tarnkeep.plans import jobs
from tarnkeep.session import scratch_dir
from tarnkeep.sinks import states as sink
from tarnkeep.sinks.states import PartStates, file_parts

CHECKS = [
    {"type": "row_count_gt", "value": 50, "name": "rows"},
    {"type": "null_pct_lt", "column": "t", "threshold": 30.0},
    {"type": "unique_keys", "columns": ["k"], "expected": 40, "name": "plain"},
    {"type": "unique_keys", "columns": ["k"], "dense": True, "name": "dense"},
    {"type": "unique_keys", "columns": ["k", "t"], "name": "pair"},
    {"type": "no_duplicate_keys", "columns": ["k", "t"]},
    {"type": "unique_keys", "columns": ["k", "t"], "approximate": True, "name": "sketch"},
    {"type": "unique_keys", "columns": ["x"], "name": "floats"},
    {"type": "value_range", "column": "k", "min": -5, "max": 70000},
    {"type": "regex", "column": "t", "pattern": "^[a-c]*$"},
    {"type": "regex", "column": "t", "pattern": "(", "name": "bad pattern"},
    {"type": "null_pct_lt", "column": "nope", "threshold": 1.0, "name": "no column"},
    {"type": "unique_keys", "columns": ["t"], "dense": True, "name": "not dense"},
    {"type": "unheard_of"},
]


def rows(spark, seed, n=120):
    rng = random.Random(seed)
    values = [
        (rng.choice([None, -40000, -5, 0, 1, 32767, 32768, 32769, 10**12, rng.randint(-99, 99)]),
         rng.choice([None, "", "a", "b,c", "abc", "ä"]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]))
        for _ in range(n)
    ]
    return spark.createDataFrame(values, "k long, t string, x double")


def write(df, path, day):
    df.write.mode("overwrite").parquet(f"{path}/day={day}")


def reported(report):
    return sorted((str(tuple(r)) for r in report.collect()))


def whole(spark, path):
    usual = [{k: v for k, v in c.items() if k != "dense"} if c.get("name") == "dense" else c for c in CHECKS]
    return quality.run_checks(spark.read.parquet(path), usual, "t")


def test_reports_equal_full_runs_and_read_changed_parts_only(spark):
    path, store = scratch_dir(spark), PartStates(scratch_dir(spark))

    def check(read):
        got = {r.check: r for r in jobs.quality_states_job(spark, path, CHECKS, store, "t").collect()}
        want = {r.check: r for r in whole(spark, path).collect()}
        assert len(got) == len(CHECKS)
        assert got.pop("not dense").error == "dense keys are one whole-number column"
        want.pop("not dense")
        sketch, exact = got.pop("sketch"), want["pair"]
        want.pop("sketch")
        assert abs(sketch.actual - exact.actual) <= 0.05 * exact.actual
        assert got == want
        assert sorted(p.rsplit("=", 1)[1] for p in store.computed(spark)) == read

    write(rows(spark, 1), path, 1)
    write(rows(spark, 2), path, 2)
    check(["1", "2"])
    check(["1", "2"])  # nothing new: no refresh
    write(rows(spark, 3), path, 3)
    check(["3"])
    write(rows(spark, 4, 7), path, 2)
    check(["2"])
    file_system, place = sink_folder(spark, f"{path}/day=1")
    file_system.delete(place, True)
    check([])


def sink_folder(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def test_only_files_of_changed_parts_are_opened(spark):
    path, store, opened = scratch_dir(spark), PartStates(scratch_dir(spark)), []

    def compute(df):
        opened.append(sorted(f.split("day=")[1][0] for f in set(df.inputFiles())))
        return states.states(df, {"n": states.F.count("*")})

    for day in (1, 2, 3):
        write(rows(spark, day).coalesce(1), path, day)
        store.refresh(spark, path, compute, "n")
    assert opened == [["1"], ["2"], ["3"]]
    assert states.merged(store.states(spark)).first().value == 360
    # other metrics need all parts anew
    store.refresh(spark, path, compute, "other")
    assert opened[-1] == ["1", "2", "3"]


def test_many_runs_are_gathered(spark, monkeypatch):
    monkeypatch.setattr(sink, "GATHER_AT", 2)
    path, store = scratch_dir(spark), PartStates(scratch_dir(spark))
    compute = lambda df: states.states(df, {"n": states.F.count("*")}, keys={"k": ["k"]})
    for day in range(1, 6):
        write(rows(spark, day, 20), path, day)
        found = dict(states.merged(store.refresh(spark, path, compute, "n")).collect())
    all_rows = spark.read.parquet(path)
    assert found == {"n": 100, "k": all_rows.select("k").distinct().count()}


def test_distinct_counts_merge_over_parts(spark):
    df = rows(spark, 9, 300).selectExpr("*", f"cast(abs(hash(k, t)) % 4 as string) {PART_OF}")
    found = dict(states.merged(states.states(
        df, keys={"k": ["k"], "x": ["x"]}, dense={"d": "k"}, maxima={"most": states.F.max("k")},
        sketches={"s": ["k"]},
    )).collect())
    distinct = df.select("k").distinct().count()
    assert found["k"] == distinct == found["d"] + found["d|null"] and found["s"] == distinct
    assert found["x"] == df.select("x").distinct().count() and found["most"] == 10**12


def test_profiles_merge_over_files(spark, tmp_path):
    store = PartStates(scratch_dir(spark))
    texts = [
        "a,b,c,d\n1,2024-01-02,x,\n2,2024-01-03,yy,\n", "c,a,b\nzzz,3.5,\nq,4,2024-02-03\n", "d,e\n7,true\n8,0\n",
    ]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.csv").write_text(text)
        got = jobs.profile_states_job(spark, str(tmp_path), store, "a", "t")
        assert [p.rsplit("/", 1)[1] for p in store.computed(spark)] == [f"{n}.csv"]
    types = {r.column: (r.sql_type, r.filled, r.max_length) for r in got.collect()}
    assert types == {
        "a": ("FLOAT", 4, 3), "b": ("DATETIME2", 3, 10), "c": ("NVARCHAR(3)", 4, 3), "d": ("BIGINT", 2, 1),
        "e": ("BIT", 2, 4),
    }
    one = spark.read.option("header", True).csv(str(tmp_path / "0.csv"))
    full = {r.column: (r.sql_type, r.rows, r.filled) for r in profile(one, "a", "t").collect()}
    assert full["a"] == ("BIGINT", 2, 2)


def test_part_fingerprints(spark):
    path = scratch_dir(spark)
    write(rows(spark, 1), path, 1)
    before = file_parts(spark, path)
    write(rows(spark, 2), path, 2)
    after = file_parts(spark, path)
    assert len(before) == 1 and len(after) == 2 and before.items() <= after.items()
    assert len(file_parts(spark, path, "file")) >= 2
    with pytest.raises(ValueError, match="folder or file"):
        file_parts(spark, path, "row")
