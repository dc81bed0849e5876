from datetime import date, datetime
from decimal import Decimal

import pytest

from tarnkeep.operators.contracts import (
    Contract, apply_contract, drop_incomplete, rename, with_audit,
)
from tarnkeep.operators.counts import CONTROL
from tarnkeep.session import materialize, scratch_dir
from tarnkeep.sinks.tables import (
    append_by_position, close_current, ensure_schema, ensure_table, write_path, write_table,
)
from tarnkeep.sources.files import read_csv, read_csv_text, read_path, table_exists

CONTRACT = Contract({"d": "DATE", "n": "INT", "b": "BIGINT", "m": "DECIMAL(10,2)", "x": "DOUBLE"})


def cast_one(spark, **values):
    row = {"d": None, "n": None, "b": None, "m": None, "x": None} | values
    df = spark.createDataFrame([tuple(row.values())], "d string, n string, b string, m string, x string")
    return apply_contract(df, CONTRACT).first()


@pytest.mark.parametrize("column, text, expected", [
    ("d", "2024-02-29", date(2024, 2, 29)),
    ("d", "2023-02-29", None),
    ("d", "2024-1-2", None),
    ("d", "x", None),
    ("n", "12", 12),
    ("n", " 12 ", 12),
    ("n", "3.7", 3),
    ("n", "-3.7", -3),
    ("n", "99999999999", None),
    ("n", "12a", None),
    ("n", "", None),
    ("b", "9007199254740993", 9007199254740993),
    ("m", "12.345", Decimal("12.35")),
    ("m", "123456789.00", None),
    ("m", "1,5", None),
    ("x", "1e3", 1000.0),
    ("x", "one", None),
])
def test_bad_values_become_null(spark, column, text, expected):
    assert cast_one(spark, **{column: text})[column] == expected


def test_typed_input_is_kept_or_cast(spark):
    df = spark.sql("select date'2024-01-01' d, 5L n, 3 b, 1.239 m, 2 x, 'more' other")
    row = apply_contract(df, CONTRACT, keep_others=True).first()
    assert row.asDict() == {
        "d": date(2024, 1, 1), "n": 5, "b": 3, "m": Decimal("1.24"), "x": 2.0, "other": "more",
    }


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="'x'"):
        apply_contract(spark.sql("select '1' d, '1' n, '1' b, '1' m"), CONTRACT)


def test_csv_is_read_by_header_and_keeps_leading_zeros(spark):
    path = scratch_dir(spark)
    spark.sql("select '00501' zip, 'x,\"y' name, '7' n union all select null, '', 'q'").coalesce(
        1
    ).write.option("header", True).csv(path)
    rows = read_csv(spark, path, Contract({"n": "INT", "zip": "STRING", "name": "STRING"}))
    assert {tuple(r) for r in rows.collect()} == {(7, "00501", 'x,"y'), (None, None, None)}


def test_csv_files_with_another_column_order_fail(spark):
    one, two = scratch_dir(spark), scratch_dir(spark)
    spark.sql("select 1 a, 2 b").write.option("header", True).csv(one)
    spark.sql("select 2 b, 1 a").write.option("header", True).csv(two)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, [one, two]).collect()


def test_projection_helpers(spark):
    df = spark.sql("select 1 a, cast(null as int) b union all select 2, 3")
    assert rename(df, {"a": "z"}).columns == ["z", "b"]
    assert drop_incomplete(df).count() == 1
    assert drop_incomplete(df, ["a"]).count() == 2
    stamped = with_audit(df, "at", "2024-05-06 07:08:09").first()["at"]
    assert stamped == datetime(2024, 5, 6, 7, 8, 9)
    assert with_audit(df, "at").schema["at"].dataType.simpleString() == "timestamp"


def test_named_tables(spark):
    schema = "named_tables"
    ensure_schema(spark, schema, scratch_dir(spark))
    control, other = f"{schema}.control", f"{schema}.other"
    assert not table_exists(spark, control)
    ensure_table(spark, control, CONTROL)
    ensure_table(spark, control, CONTROL)
    assert table_exists(spark, control)
    append_by_position(spark.sql("select 'a' x, 5L y, timestamp'2024-01-01 00:00:00' z"), control)
    row = spark.table(control).first()
    assert (row["Table_name"], row["Table_count"]) == ("a", Decimal("5.0000"))

    write_table(spark.range(3), other)
    write_table(spark.range(3).selectExpr("id", "id * 2 twice"), other)
    write_table(spark.range(2).selectExpr("id", "id twice"), other, "append")
    assert spark.table(other).count() == 5


def test_paths(spark):
    path = scratch_dir(spark)
    assert not table_exists(spark, path)
    write_path(spark.range(3), path)
    write_path(spark.range(2), path, "append")
    assert table_exists(spark, path)
    assert read_path(spark, path).count() == 5
    write_path(spark.range(1).withColumnRenamed("id", "n"), path)
    assert read_path(spark, path).columns == ["n"]
    write_path(spark.range(1), path, fmt="json")
    assert read_path(spark, path, "json").count() == 1


def test_merge_needs_row_level_updates(spark):
    ensure_schema(spark, "merging", scratch_dir(spark))
    write_table(
        spark.sql("select 1 k, true current_flag, cast(null as date) effective_end_date"),
        "merging.history",
    )
    with pytest.raises(Exception, match="MERGE"):
        close_current(spark.sql("select 1 k"), "merging.history", ["k"], "2024-01-01")


def test_materialized_frames_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "id % 2 as part")
    assert materialize(df).dtypes == df.dtypes
    split = materialize(df, ["part"])
    assert split.filter("part = 1").count() == 5
    assert materialize(df.filter("false"), ["part"]).count() == 0
