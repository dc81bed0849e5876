import json

import pytest

from tarnkeep.operators.records import extract_items, infer_item_schema, items_to_table
from tarnkeep.session import scratch_dir


def items(spark, body, path="data.items"):
    df = spark.createDataFrame([(body,)], "body string")
    return [json.loads(r[0]) for r in extract_items(df, "body", path).selectExpr("to_json(item)").collect()]


@pytest.mark.parametrize("path, body, expected", [
    ("items", '[{"a":1},{"a":2}]', [{"a": 1}, {"a": 2}]),
    ("items", '{"items":[1,"x",null]}', [1, "x", None]),
    ("items", '{"items":{"a":1}}', [{"a": 1}]),
    ("items", '{"items":"one"}', ["one"]),
    ("items", '{"items":[],"other":[1]}', []),
    ("items", '{"items":null,"zz":[1],"aa":[2]}', [1]),
    ("items", '{"n":"[1]","zz":{"deep":[1]},"yy":[3]}', [3]),
    ("items", '{"n":1}', []),
    ("items", '5', []),
    ("items", None, []),
    ("data.items", '{"data":{"items":[1,2]}}', [1, 2]),
    ("data.items", '{"data":{"other":1},"list":[7]}', [7]),
    ("data.items", '{"data":5,"list":[7]}', [7]),
    ("a b.c'd", '{"a b":{"c\'d":[1]}}', [1]),
    ("", '{"a":[1],"b":2}', [{"a": [1], "b": 2}]),
    (None, '[1,2]', [1, 2]),
])
def test_where_records_are(spark, path, body, expected):
    assert items(spark, body, path) == expected


def table(spark, *records, schema=None):
    body = json.dumps(list(records))
    found = extract_items(spark.createDataFrame([(body,)], "body string"), "body", "items")
    return items_to_table(found, schema)


def test_types_are_inferred(spark):
    df = table(
        spark,
        {"n": 1, "x": 1.5, "s": "a", "f": True, "m": {"p": 1}, "l": [1, 2], "z": None, "t": "u"},
        {"n": None, "x": 2.25, "s": 5, "f": False, "m": {"q": 2}, "l": [], "st": {"a": 1, "b": "c"}},
    )
    assert dict(df.dtypes) == {
        "n": "bigint", "x": "double", "s": "string", "f": "boolean", "m": "map<string,bigint>",
        "l": "array<bigint>", "z": "string", "t": "string", "st": "struct<a:bigint,b:string>",
    }
    assert df.columns == sorted(df.columns)
    second = df.filter("n is null").first()
    assert (second.x, second.s, second.m, second.l, second.st.b) == (2.25, "5", {"q": 2}, [], "c")


@pytest.mark.parametrize("records", [
    [{"a": 1, "b": 1}, {"a": 1.5, "b": 2}],
    [{"a": 1, "b": 1}, {"a": {"x": 1}, "b": 2}],
    [{"a": [1], "b": 1}, {"a": ["x"], "b": 2}],
    [{"a": {"x": 1}, "b": 1}, {"a": {"x": "y"}, "b": 2}],
])
def test_conflicting_types_make_every_column_text(spark, records):
    df = table(spark, *records, {"c": None})
    assert set(df.dtypes) == {("a", "string"), ("b", "string"), ("c", "string")}
    assert sorted(str(r.b) for r in df.collect()) == ["1", "2", "None"]


def typed(spark, *records, **options):
    body = json.dumps(list(records))
    found = extract_items(spark.createDataFrame([(body,)], "body string"), "body", "items")
    return infer_item_schema(found, **options).simpleString()


def test_types_are_found_at_any_depth(spark):
    assert typed(
        spark,
        {"a": {"b": [{"c": 1, "d": None}, {"c": 2.5}], "e": {}}, "f": [[1], []], "g": [], "h": [None]},
        {"a": {"b": [], "e": {"x": "y"}}, "f": [[12345678901234567890]], "g": None},
        {"a": None, "f": [], "z": {"p": {"q": True}, "r": [1]}}, 7, None, [{"no": 1}],
    ) == (
        "struct<a:struct<b:array<struct<c:double,d:string>>,e:map<string,string>>,"
        "f:array<array<decimal(38,0)>>,g:array<string>,h:array<string>,"
        "z:struct<p:map<string,boolean>,r:array<bigint>>>"
    )


def test_keys_that_are_data_become_maps(spark):
    records = [
        {"id": i, "by": {f"u{i}": {"n": i, "s": "x"}}, "deep": [{f"k{i}": {f"m{i}": 1.5}}]} for i in range(30)
    ]
    assert typed(spark, *records, most_keys=29) == (
        "struct<by:map<string,struct<n:bigint,s:string>>,deep:array<map<string,map<string,double>>>,id:bigint>"
    )
    wide = [{f"u{i}": i} for i in range(30)]
    assert typed(spark, *wide, most_keys=29) == "map<string,bigint>"
    assert typed(spark, *wide, most_keys=30).startswith("struct<u0:bigint,u1:bigint")
    assert typed(spark, *wide, {"v": "text"}, most_keys=29) == "map<string,string>"
    # a value that differs in kind under one key of a map leaves no shared type
    odd = [{"id": i, "by": {f"u{i}": i if i else "x"}} for i in range(30)]
    assert typed(spark, *odd, most_keys=29) == "struct<by:string,id:string>"


def test_records_with_data_keys_are_read_as_maps(spark):
    body = json.dumps([{f"u{i}": {"n": i}} for i in range(20)] + [{}, 5])
    found = extract_items(spark.createDataFrame([(body,)], "body string"), "body", "items")
    rows = [r.value for r in items_to_table(found, most_keys=10).collect()]
    assert rows == [{f"u{i}": {"n": i}} for i in range(20)] + [{}, None]


def test_given_schema_and_misfits(spark):
    df = table(spark, {"a": "5", "b": {"x y": 1}}, {"a": "q"}, schema="a INT, b STRUCT<`x y`: INT>, c DATE")
    assert [(r.a, r.b and r.b["x y"], r.c) for r in df.collect()] == [(5, 1, None), (None, None, None)]


def test_records_that_are_no_objects(spark):
    assert [r.value for r in table(spark, 1, "x").collect()] == ["1", "x"]
    empty = spark.createDataFrame([("[]",)], "body string")
    assert infer_item_schema(extract_items(empty)).fields == []


def test_other_columns_are_kept_and_records_can_be_written(spark):
    df = spark.createDataFrame([(3, '[{"a":1},{"a":2}]')], "page int, body string")
    path = scratch_dir(spark)
    extract_items(df).write.parquet(path)
    assert spark.read.parquet(path).filter("page = 3").count() == 2
