from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tarnkeep.operators.contracts import Contract, apply_contract
from tarnkeep.operators.dedup import (
    distinct_keys, distinct_rows, duplicate_row_count, first_per_key,
)
from tarnkeep.operators.rules import (
    annotate, flag_regex, order_rules, split, violation_counts,
)
from tarnkeep.plans.tables import ORDERS

SCHEMA = (
    "order_id string, customer_id string, order_date date, product_name string, quantity int, "
    "unit_price decimal(10,2), total_amount decimal(10,2)"
)
GOOD = ("o", "c", "2024-01-01", "p", 2, "3.50", "7.00")


def orders(spark, *changes):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    rows = [tuple((dict(zip(names, GOOD)) | c).values()) for c in changes]
    text = ", ".join(f"{n} string" for n in names)
    raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], text)
    return apply_contract(raw, Contract({n: ORDERS.columns[n] for n in names}))


def test_each_rule(spark):
    df = orders(
        spark, {}, {"order_id": None}, {"order_date": "2024-13-01"}, {"quantity": 0},
        {"unit_price": "-1", "total_amount": "-2"}, {"total_amount": "7.01"}, {"quantity": None},
    )
    broken = [
        sorted(r["violations"]) for r in annotate(df, order_rules()).select("violations").collect()
    ]
    assert broken == [
        [], ["order_id_missing"], ["order_date_missing"],
        ["quantity_not_positive", "total_inconsistent"],
        ["total_negative", "unit_price_negative"], ["total_inconsistent"], ["quantity_missing"],
    ]
    good, bad = split(df, order_rules())
    assert (good.count(), bad.count()) == (1, 6)
    counted = {r["rule"]: r["rows"] for r in violation_counts(df, order_rules()).collect()}
    assert counted["total_inconsistent"] == 2 and counted["customer_id_missing"] == 0


values = st.fixed_dictionaries({
    "order_id": st.sampled_from([None, "1"]),
    "quantity": st.sampled_from([None, -1, 0, 2]),
    "unit_price": st.sampled_from([None, "-1.00", "3.50"]),
    "total_amount": st.sampled_from([None, "-1.00", "7.00", "7.01"]),
})


@settings(max_examples=8, deadline=None, derandomize=True, database=None,
          phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(values, max_size=8))
def test_good_and_bad_are_the_input(spark, changes):
    df = orders(spark, {}, *changes)
    good, bad = split(df, order_rules())
    both = good.unionByName(bad)
    assert both.exceptAll(df).isEmpty() and df.exceptAll(both).isEmpty()
    assert annotate(good, order_rules()).filter("size(violations) > 0").isEmpty()


def test_survivor_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).selectExpr("id % 7 as k", "(id * 37) % 1999 as v", "cast(id % 3 as string) s")
    results = [
        {tuple(r) for r in first_per_key(df.repartition(n), ["k"]).collect()} for n in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 7
    latest = first_per_key(df, ["k"], [df.v.desc()]).agg({"v": "min"}).first()[0]
    assert latest == min(r["m"] for r in df.groupBy("k").agg({"v": "max"}).toDF("k", "m").collect())


def test_null_keys_are_one_key(spark):
    df = spark.sql("select cast(null as int) k, 1 v union all select null, 2 union all select 1, 3")
    assert {tuple(r) for r in first_per_key(df, ["k"]).collect()} == {(None, 1), (1, 3)}


def test_duplicates(spark):
    df = spark.sql("select * from values (1, 'a'), (1, 'a'), (1, null), (1, null), (2, 'a') t(n, s)")
    assert duplicate_row_count(df).first()[0] == 2
    assert duplicate_row_count(df.filter("false")).first()[0] == 0
    assert distinct_rows(df).count() == 3
    assert distinct_keys(df, ["n"]).count() == 2


def test_regex_flag_on_raw_text(spark):
    df = spark.sql("select * from values ('2024-01-02'), ('2024-1-2'), (null) t(d)")
    flags = [r["ok"] for r in flag_regex(df, "d", r"^\d{4}-\d{2}-\d{2}$", "ok").collect()]
    assert flags == [True, False, None]
