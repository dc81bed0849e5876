"""Measures kept over loads: equal to a full run, without reading the facts before."""

import pytest
from pyspark.sql import functions as F

import plans
from test_measures import EXPECTED, SALES
from tarnkeep.plans.grains import MeasureStore
from tarnkeep.plans.measures import MEASURES, measures
from tarnkeep.session import scratch_dir


@pytest.fixture(scope="module")
def sales(spark):
    return spark.sql(SALES).withColumn("n", F.monotonically_increasing_id())


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("dims", [[], ["product_name"], ["order_status"]])
def test_loads_in_any_cut_equal_a_full_run(spark, sales, dims):
    store = MeasureStore(scratch_dir(spark), list(MEASURES), dims, buckets=4)
    with pytest.raises(ValueError, match="no load"):
        store.measures(spark)
    # orders and customers are cut apart
    for load, part in enumerate((sales.filter("quantity > 1"), sales.filter("false"), sales.filter("quantity = 1"))):
        assert store.append(part.drop("n"), f"load {load}")
    assert not store.append(sales.drop("n"), "load 0")
    assert rows(store.measures(spark)) == rows(measures(sales, None, dims))
    if not dims:
        row = store.measures(spark).first()
        assert {n: row[c] for n, c in MEASURES.items()} == EXPECTED


@pytest.mark.parametrize("names", [["Total Sales"], ["Total Orders"], ["Repeat Customers"], ["Orders per Customer"]])
def test_each_choice_of_grains(spark, sales, names):
    store = MeasureStore(scratch_dir(spark), names, ["product_name"], buckets=3)
    for part in (0, 1, 2):
        store.append(sales.filter(f"n % 3 = {part}"), str(part))
    assert rows(store.measures(spark)) == rows(measures(sales, names, ["product_name"]))


def test_only_touched_buckets_are_written_and_no_fact_is_read_again(spark, sales):
    facts = scratch_dir(spark)
    spark.range(5000).selectExpr(
        "concat('o', id) order_id", "concat('c', id % 700) customer_id", "cast(id % 90 as decimal(10,2)) total_amount",
    ).write.parquet(facts)
    store = MeasureStore(scratch_dir(spark), ["Total Orders", "Total Customers", "Total Sales"], buckets=32)
    store.append(spark.read.parquet(facts), "first")
    one = spark.sql("select 'o17' order_id, 'c17' customer_id, cast(5 as decimal(10,2)) total_amount")
    store.append(one, "second")
    _, state = store._state(spark)
    assert sum(run == 2 for run in state["buckets"].values()) <= 2  # one order, one customer
    assert store.measures(spark).first() == (5000, 700, spark.read.parquet(facts).agg(F.sum("total_amount")).first()[0] + 5)
    opened = store.measures(spark).inputFiles()
    assert opened and all("/totals/run=" in f for f in opened)
    assert plans.count(store.measures(spark), "SortMergeJoin") == 0


def test_other_measures_are_refused(spark, sales):
    store = MeasureStore(scratch_dir(spark), ["Total Sales"], buckets=2)
    store.append(sales, "a")
    with pytest.raises(ValueError, match="other measures"):
        MeasureStore(store.path, ["Total Orders"], buckets=2).measures(spark)
    with pytest.raises(ValueError, match="can't be named"):
        MeasureStore(store.path, ["Total Sales"], ["bucket"])
