import gzip
import json
import os

import pytest

import plans

from tarnkeep import session
from tarnkeep.operators import quality
from tarnkeep.operators.contracts import Contract, apply_contract
from tarnkeep.operators.records import (
    body_rejects, extract_items, infer_item_schema, items_to_table,
)
from tarnkeep.operators.scd2 import record_hash
from tarnkeep.plans import jobs
from tarnkeep.session import scratch_dir
from tarnkeep.sinks.tables import write_report
from tarnkeep.sources.files import csv_rejects, header_groups, read_csv, read_csv_by_name


def test_whole_numbers_keep_all_digits(spark):
    texts = {
        "9007199254740993.0": 9007199254740993, "12345678901234567.5": 12345678901234567,
        "9223372036854775808": None, "9223372036854775808.0": None, "1e3": 1000, "1e30": None,
        "3.7": 3, "-3.7": -3, ".5": 0, "-.5": 0, " 42 ": 42, "x": None, "": None, "12.5.1": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    contract = Contract({"n": "bigint"})
    got = df.select("n").withColumn("t", df["n"])
    rows = apply_contract(got, contract, keep_others=True).collect()
    assert {r["t"]: r["n"] for r in rows} == texts


def test_separators_in_values_change_the_hash(spark):
    df = spark.createDataFrame(
        [("a||b", "c"), ("a", "b||c"), ("a\\", "|b"), ("a\\|", "b")], "x string, y string"
    )
    assert df.select(record_hash(["x", "y"], "\x00").alias("h")).distinct().count() == 4


def test_checks_that_cannot_be_evaluated_fail_alone(spark):
    df = spark.createDataFrame([(1, "a", None)], "n int, s string, d date")
    checks = [
        {"type": "regex", "column": "s", "pattern": "("},
        {"type": "null_pct_lt", "column": "s", "threshold": "x"},
        {"type": "value_range", "column": "n", "min": "low"},
        {"type": "value_range", "column": "d", "min": 5},
        {"type": "value_range", "column": "s", "max": 5},
        {"type": "row_count_gt", "value": 0},
        {"type": "unique_keys", "columns": ["n"], "approximate": True},
    ]
    rows = quality.run_checks(df, checks).collect()
    assert [r["passed"] for r in rows] == [False] * 5 + [True] * 2
    assert all(r["error"] for r in rows[:5])


def test_a_table_that_is_absent_and_a_configuration_file(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three_rows")
    check = [{"type": "row_count_gt", "value": 1}]
    config = {"tables": [{"table": t, "checks": check} for t in ("no_such_table", "three_rows")]}
    (tmp_path / "checks.json").write_text(json.dumps(config))
    read = quality.read_config(spark, str(tmp_path / "checks.json"))
    rows = quality.run_config(spark, read).collect()
    assert [r["passed"] for r in rows] == [False, True]


@pytest.mark.parametrize("body", ["not json", '{"items":[{"id":1}', '[{"a":1,"a":2}]', ""])
def test_bodies_that_cannot_be_read(spark, body):
    df = spark.createDataFrame([(1, body), (2, "[5]"), (3, None)], "n int, body string")
    with pytest.raises(Exception, match="can't be read"):
        extract_items(df).collect()
    assert [r["n"] for r in extract_items(df, on_broken="skip").collect()] == [2]
    assert [tuple(r) for r in body_rejects(df).collect()] == [(1, body)]


def test_large_whole_numbers_of_records(spark):
    def rows(text):
        items = extract_items(spark.createDataFrame([(text,)], "body string"))
        return items_to_table(items)

    wide = rows('[{"i":12345678901234567890},{"i":12345678901234567891},{"i":3},'
                '{"i":100000000000000000000}]')
    assert dict(wide.dtypes) == {"i": "decimal(38,0)"}
    assert {int(r.i) for r in wide.collect()} == {
        12345678901234567890, 12345678901234567891, 3, 10**20,
    }
    nested = rows('[{"l":[12345678901234567890, 1]}]')
    assert dict(nested.dtypes) == {"l": "array<decimal(38,0)>"}
    assert dict(rows('[{"f":1.0},{"f":2.5}]').dtypes) == {"f": "double"}
    assert dict(rows(f'[{{"n":{2**63 - 1}}}]').dtypes) == {"n": "bigint"}


def test_many_keys_make_a_map_and_no_columns(spark):
    df = spark.createDataFrame([('[{"a":1,"b":2},{"c":3}]',)], "body string")
    items = extract_items(df)
    assert infer_item_schema(items, most_keys=3).names == ["a", "b", "c"]
    assert infer_item_schema(items, most_keys=2).simpleString() == "map<string,bigint>"


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["a,b", "1,x", "2,y,z", "3", '4,"two', 'lines"', "5,"]
    (tmp_path / "in" / "part.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "in")
    contract = Contract({"a": "int", "b": "string"})
    for pruned in ([], ["a"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_csv(spark, path, contract).select(*pruned or ["*"]).collect()
    assert read_csv(spark, path, contract, {"mode": "PERMISSIVE"}).count() == 6
    rejected = {r["line"] for r in csv_rejects(spark, path).collect()}
    assert {"2,y,z", "3", 'lines"'} <= rejected and not {"1,x", "5,"} & rejected

    bad, clean = str(tmp_path / "bad"), str(tmp_path / "clean")
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")))
    counts = jobs.cleanse_orders_job(
        spark, path, clean, bad, contract, [], ["a"], options={"multiLine": "true"}
    )
    assert (counts.source, counts.clean, counts.bad) == (5, 3, 2)
    kept = {r["malformed_line"]: list(r["violations"]) for r in spark.read.parquet(bad).collect()}
    assert kept == {"2,y,z": ["malformed_line"], "3": ["malformed_line"]}
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))) == before


def test_a_repeated_run_date_replaces_its_report(spark):
    target = scratch_dir(spark)
    report = quality.run_checks(spark.range(3), [{"type": "row_count_gt"}])
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        write_report(report, target, day)
    assert spark.read.json(target).count() == 2


def test_reports_of_several_tables_on_one_day_are_all_kept(spark):
    target = scratch_dir(spark)
    for name, rows in (("t1", 3), ("t2", 4), ("t1", 5)):
        spark.range(rows).createOrReplaceTempView(name)
        config = {"tables": [{"table": name, "checks": [{"type": "row_count_gt", "value": 1}]}]}
        jobs.quality_job(spark, config, target, "2024-01-01")
    kept = spark.read.schema(quality.REPORT).json(target).collect()
    assert sorted((r.table, r.actual) for r in kept) == [("t1", 5.0), ("t2", 4.0)]


def test_csv_files_with_differing_headers(spark, tmp_path):
    texts = {
        "a.csv": "k,v,w\n1,a,x\n2,\"b,c\",y\n", "b.csv": "# note\n\nw,k,v\nz,3,d\n", "c.csv": "v,k\ne,4\n",
        "d.csv": "k,v,w\n5,f,u\n", "empty.csv": "",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "e.csv.gz", "wt") as out:
        out.write("w,k,v\nt,6,g\n")
    options = {"comment": "#"}
    got = read_csv_by_name(spark, str(tmp_path), options)
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect())) == [
        ("1", "a", "x"), ("2", "b,c", "y"), ("3", "d", "z"), ("4", "e", None), ("5", "f", "u"), ("6", "g", "t"),
    ]
    assert sorted(map(len, header_groups(spark, str(tmp_path), options))) == [1, 2, 2]
    assert plans.count(got, "FileScan csv") == 3 and len(got.inputFiles()) == 5  # each file once
    contract = Contract({"k": "bigint", "w": "string", "v": "string"})
    typed = read_csv(spark, str(tmp_path), contract, options, "line", by_name=True)
    assert typed.columns == ["k", "w", "v", "line"] and {r.line for r in typed.collect()} == {None}
    (tmp_path / "f.csv").write_text("v,k\nh,7,too many\n")
    rows = read_csv(spark, str(tmp_path), contract, options, "line", by_name=True).collect()
    assert [r.line for r in rows if r.line] == ["h,7,too many"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://somewhere:7077"})

    with pytest.raises(RuntimeError, match="share"):
        session.scratch_dir(Session())
    Session.conf["spark.master"] = "local[2]"
    assert session.scratch_dir(Session())
