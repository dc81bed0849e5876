import pytest

import plans
from tarnkeep.operators.profiling import ddl, profile, profile_tables
from tarnkeep.session import scratch_dir

COLUMNS = {
    "empty": ["", None, ""],
    "whole": ["1", "-22", " 3 "],
    "large": ["3000000000", "1", ""],
    "huge": ["99999999999999999999", "1", "2"],
    "mixed": ["1", "2.5", "1e3"],
    "grouped": ["1,234", "5", "6"],
    "javaish": ["1d", "2f", "3d"],
    "dates": ["2024-01-02", "2024-01-03 04:05:06.123", "2024-01-03T04:05:06Z"],
    "us_dates": ["1/2/2024", "12/31/2024", "12/31/2024 1:02"],
    "day_first": ["31/12/2024", "1/2/2024", "30-11-2024"],
    "named": ["2 Jan 2024", "Jan 2, 2024", "2-Feb-2024"],
    "bad_dates": ["2024-13-01", "2024-01-02", "2024-01-03"],
    "bits": ["0", "1", "1"],
    "words": ["true", "FALSE", "0"],
    "yesno": ["yes", "NO", "1"],
    "text": ["ab", "äöüß", "abc"],
    "long": ["x" * 4001, "y", "z"],
    "limit": ["x" * 4000, "y", "z"],
}
A = {
    "empty": "NVARCHAR(4000)", "whole": "BIGINT", "large": "BIGINT", "huge": "FLOAT",
    "mixed": "FLOAT", "grouped": "NVARCHAR(5)", "javaish": "NVARCHAR(2)", "dates": "DATETIME2",
    "us_dates": "DATETIME2", "day_first": "DATETIME2", "named": "DATETIME2",
    "bad_dates": "NVARCHAR(10)", "bits": "BIGINT", "words": "BIT", "yesno": "NVARCHAR(3)",
    "text": "NVARCHAR(4)", "long": "NVARCHAR(MAX)", "limit": "NVARCHAR(4000)",
}
B = A | {"large": "FLOAT", "grouped": "FLOAT", "yesno": "BIT"}


@pytest.fixture(scope="module")
def df(spark):
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame(list(zip(*COLUMNS.values())), schema)


@pytest.mark.parametrize("ladder, expected", [("a", A), ("b", B)])
def test_ladders(df, ladder, expected):
    assert {r["column"]: r["sql_type"] for r in profile(df, ladder).collect()} == expected


def test_one_scan(df):
    profiled = profile(df)
    assert plans.count(profiled, "Exchange") == 1


def test_definitions_can_be_run(spark, df):
    odd = spark.sql("select '1' `a b`, 'x' `c``d`")
    made = ddl(profile_tables({"all-columns": df, "odd": odd}), "profiled").collect()
    assert {r["table_name"] for r in made} == {"all-columns", "odd"}
    spark.sql(made[0]["schema_ddl"] + f" LOCATION '{scratch_dir(spark)}'")
    for r in made:
        spark.sql(r["table_ddl"])
    types = dict(spark.table("profiled.all_columns").dtypes)
    assert list(types) == list(COLUMNS)
    assert (types["whole"], types["mixed"], types["dates"], types["words"], types["text"]) == (
        "bigint", "double", "timestamp", "boolean", "string",
    )
    assert spark.table("profiled.odd").columns == ["a b", "c`d"]
