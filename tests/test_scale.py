"""Hot keys, and the number of times the facts are read."""

import plans
import pytest

from tarnkeep.fixtures import orders_like
from tarnkeep.operators.dedup import first_per_key
from tarnkeep.operators.quality import distinct_count
from tarnkeep.operators.scd2 import scd2_stage
from tarnkeep.plans.calendar import sales_calendar
from tarnkeep.plans.measures import measures
from tarnkeep.session import scratch_dir
from tarnkeep.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key."""
    path = scratch_dir(spark)
    spark.range(30000).selectExpr(
        "case when id % 3 = 0 then -1 else id div 2 end as k", "id % 1000 as v",
        "cast(id as string) as text",
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_dedup_limits_each_key_before_the_shuffle(spark, skewed):
    plan = plans.physical(first_per_key(skewed, ["k"]))
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]
    rows = first_per_key(skewed, ["k"])
    assert rows.count() == skewed.select("k").distinct().count()
    assert rows.filter("k = -1").first()["v"] == 0


def test_stage_of_skewed_input(spark, skewed):
    staged = scd2_stage(skewed, ["k"], ["v", "text"], "2024-01-01")
    plan = plans.physical(staged)
    assert "Partial" in plan[plan.index("Exchange hashpartitioning"):]
    assert staged.filter("k = -1").count() == 1


def test_distinct_counts_combine_before_the_shuffle(skewed):
    plan = plans.physical(distinct_count(skewed, ["k", "v"]))
    assert "partial_count" in plan and "HashAggregate" in plan[plan.rindex("Exchange"):]
    assert distinct_count(skewed, ["k", "v"]).first()[0] == skewed.select("k", "v").distinct().count()


def test_skewed_join_below_a_dedup_is_split(spark, skewed):
    names = spark.range(-1, 20000).selectExpr("id as k", "concat('name', id) as name")
    options = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": 16,
    }
    with plans.settings(spark, **{k.replace(".", "__"): v for k, v in options.items()}):
        joined = first_per_key(skewed.join(names, "k"), ["k", "v"])
        count = len(joined.collect())
        assert "skew=true" in plans.physical(joined)
    assert count == skewed.filter("k < 20000").select("k", "v").distinct().count()


def fact_scans(df, marker):
    plan = plans.physical(df)
    return sum("FileScan" in line and marker in line for line in plan.splitlines())


def test_facts_are_scanned_once(spark):
    orders = orders_like(spark, SF_DIR)
    assert fact_scans(measures(orders, None, ["region"]), "l_orderkey") == 1
    assert fact_scans(sales_calendar(orders), "l_orderkey") == 0  # only the saved day totals
    for name in ("dq_report", "orders_violation_counts", "column_cardinality", "orders_dedup"):
        assert fact_scans(QUERIES[name](spark, SF_DIR), "l_orderkey") == 1, name


def test_filters_and_columns_reach_the_scan(spark):
    good = QUERIES["repeat_customers"](spark, SF_DIR)
    lines = [x for x in plans.physical(good).splitlines() if "FileScan" in x and "l_orderkey" in x]
    assert len(lines) == 1 and "ReadSchema: struct<l_orderkey:bigint>" in lines[0]
    flagged = QUERIES["scd2_current"](spark, SF_DIR)
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plans.physical(flagged)
