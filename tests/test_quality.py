import pytest

import plans
from tarnkeep.functions.predicates import is_blank, not_matching, out_of_range
from tarnkeep.operators.counts import (
    CONTROL, category_counts, column_cardinality, latest_entries, log_row_count, row_count,
    table_counts,
)
from tarnkeep.operators.quality import (
    REPORT, distinct_count, null_percentage, regex_violations, run_checks, run_checks_on_table,
    run_config, value_range_violations,
)
from tarnkeep.plans.jobs import quality_job
from tarnkeep.session import scratch_dir
from tarnkeep.sinks.tables import ensure_schema, ensure_table

TABLE = """select * from values
    (1, 'a', 10.0, date'2024-01-01'), (2, '', -1.0, null), (2, null, 101.0, date'2025-01-01'),
    (null, 'zz', null, null) t(id, s, v, d)"""


@pytest.fixture(scope="module")
def df(spark):
    return spark.sql(TABLE)


def one(frame):
    return frame.first()[0]


def test_single_measures(df):
    assert row_count(df) == 4
    assert one(null_percentage(df, "s")) == 50.0
    assert one(null_percentage(df, "id")) == 25.0
    assert one(null_percentage(df, "d")) == 50.0
    assert one(null_percentage(df.filter("false"), "s")) == 0.0
    assert one(distinct_count(df, "id")) == 3
    assert one(distinct_count(df, ["id", "d"])) == 4
    assert one(distinct_count(df.filter("false"), ["id"])) == 0
    assert one(value_range_violations(df, "v", 0, 100)) == 2
    assert one(value_range_violations(df, "v", low=0)) == 1
    assert one(value_range_violations(df, "v", high=100)) == 1
    assert one(value_range_violations(df, "v")) == 0
    assert one(value_range_violations(df, "d", "2024-06-01")) == 1
    assert one(regex_violations(df, "s", "^a$")) == 2
    assert one(regex_violations(df, "d", "^2024")) == 1


def test_predicates_on_text_numbers(spark):
    df = spark.sql("select * from values ('5'), ('500'), ('x'), (null) t(v)")
    assert one(value_range_violations(df, "v", 0, 100)) == 1
    flags = df.select(
        is_blank(df.v), out_of_range(df.v, 0, 100, df.schema["v"].dataType), not_matching(df.v, "5")
    ).collect()
    assert tuple(flags[1]) == (False, True, False)


CHECKS = [
    {"type": "row_count_gt"},
    {"type": "row_count_gt", "value": 4, "name": "more"},
    {"type": "null_pct_lt", "column": "s", "threshold": 50.0},
    {"type": "null_pct_lt", "column": "s", "threshold": 50.1},
    {"type": "unique_keys", "columns": ["id"]},
    {"type": "unique_keys", "columns": ["id"], "expected": 4},
    {"type": "no_duplicate_keys", "columns": ["id"]},
    {"type": "value_range", "column": "v", "min": -5, "max": 200},
    {"type": "regex", "column": "s", "pattern": "a|^$"},
    {"type": "null_pct_lt", "column": "s"},
    {"type": "regex", "column": "s"},
    {"type": "value_range", "column": "nope", "min": 1},
    {"type": "unique_keys"},
    {"type": "magic"},
]


def test_report(df):
    report = run_checks(df, CHECKS, "t")
    assert report.schema.names == REPORT.names
    got = [(r["passed"], r["actual"], r["error"]) for r in report.collect()]
    assert got == [
        (True, 4.0, None), (False, 4.0, None), (False, 50.0, None), (True, 50.0, None),
        (True, 3.0, None), (False, 3.0, None), (False, 1.0, None), (True, 0.0, None),
        (False, 1.0, None), (False, None, "check has no threshold"),
        (False, None, "check has no pattern"), (False, None, "unknown column: nope"),
        (False, None, "check names no column"), (False, None, "unknown check type"),
    ]
    assert {(r["table"], r["total_rows"]) for r in report.collect()} == {("t", 4)}
    assert report.collect()[1]["check"] == "more"
    assert run_checks(df, [], "t").count() == 0


def test_all_checks_read_the_table_once(spark, df):
    path = scratch_dir(spark)
    df.write.parquet(path)
    report = run_checks(spark.read.parquet(path), CHECKS, "t")
    assert plans.count(report, "FileScan") == 1


def test_config_and_job(spark, df):
    df.createOrReplaceTempView("checked")
    config = {"tables": [
        {"table": "checked", "checks": CHECKS[:2]}, {"table": "checked", "checks": CHECKS[2:3]},
    ]}
    assert run_checks_on_table(spark, "checked", CHECKS[:1]).first()["table"] == "checked"
    assert run_config(spark, config).count() == 3
    assert run_config(spark, {}).count() == 0
    target = scratch_dir(spark)
    for day in ("2024-01-01", "2024-01-02"):
        assert quality_job(spark, config, target, day).count() == 3
    saved = spark.read.json(target)
    assert saved.count() == 6
    assert {str(r[0]) for r in saved.select("run_date").distinct().collect()} == {
        "2024-01-01", "2024-01-02",
    }


def test_cardinality_counts_null_once(spark):
    df = spark.sql("""select * from values
        (1, 0.0D, 'a', array(1, null), x'00'), (1, -0.0D, null, array(1), x'01'),
        (2, double('nan'), null, array(1), null) t(i, f, s, arr, b)""")
    got = {r["column"]: r["distinct_values"] for r in column_cardinality(df).collect()}
    assert got == {"i": 2, "f": 2, "s": 2, "arr": 2, "b": 3}
    assert {tuple(r) for r in category_counts(df, "s").collect()} == {("a", 1), (None, 2)}


def test_approximate_cardinality(spark):
    df = spark.range(2000).selectExpr("id", "id % 3 AS few", "CAST(NULL AS STRING) AS none")
    got = {r.column: r.distinct_values for r in column_cardinality(df, approximate=True).collect()}
    assert (got["few"], got["none"]) == (3, 1) and abs(got["id"] - 2000) < 300
    assert column_cardinality(df.limit(0), approximate=True).collect() == []


def test_row_count_log(spark, df):
    ensure_schema(spark, "logs", scratch_dir(spark))
    ensure_table(spark, "logs.control", CONTROL)
    df.createOrReplaceTempView("counted")
    for hour in range(3):
        entry = log_row_count(spark, "counted", "logs.control", f"2024-01-01 0{hour}:00:00")
        assert entry.first()["table_count"] == 4
    latest = latest_entries(spark.table("logs.control"), 2).collect()
    assert [r["count_timestamp"].hour for r in latest] == [2, 1]
    assert "TakeOrderedAndProject" in plans.physical(latest_entries(spark.table("logs.control")))
    assert {tuple(r) for r in table_counts(spark, ["counted", "logs.control"]).collect()} == {
        ("counted", 4), ("logs.control", 3),
    }
