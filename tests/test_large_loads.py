"""Loads and jobs at size: how rows are dealt and what is written must not depend on few buckets or wide copies."""

import pytest
from pyspark.sql import functions as F

from tarnkeep.operators import dedup
from tarnkeep.operators.scd2 import HASH, record_hash, scd2_stage
from tarnkeep.plans import jobs
from tarnkeep.plans.jobs import NULL_TOKEN, load_history
from tarnkeep.plans.tables import ORDERS
from tarnkeep.session import materialize, scratch_dir
from tarnkeep.sinks import buckets
from tarnkeep.sinks.buckets import KeyBuckets
from tarnkeep.sinks.history import HistoryTable
from tarnkeep.suite import queries


@pytest.fixture
def unmerged(spark):
    """Shuffle partitions stay as they are dealt, as large ones do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def sales(spark, n, price="id % 5"):
    return spark.range(n).selectExpr("id % 50 as k", "id div 50 as line", f"cast({price} as bigint) as price", "cast(null as string) as note")


def loaded(spark, snapshots, close_missing=False):
    store = KeyBuckets(scratch_dir(spark), ["k", "line"], 4)
    runs = [
        load_history(spark, rows, store, ["k", "line"], ["price", "note"], f"2024-0{i}-01", close_missing=close_missing)
        for i, rows in enumerate(snapshots, 1)
    ]
    return runs, store, sorted(map(tuple, store.history(spark).collect()), key=str)


@pytest.mark.parametrize("close_missing", [False, True])
def test_rows_that_stay_where_they_are_give_the_same_history(spark, monkeypatch, close_missing):
    twice = sales(spark, 300).union(sales(spark, 40, "9"))  # some keys come twice
    changed = sales(spark, 280, "if(id % 3 = 0, 7, id % 5)")
    snapshots = [twice, changed, changed]
    expected = loaded(spark, snapshots, close_missing)
    aligned = []
    original = KeyBuckets._as_met
    monkeypatch.setattr(buckets, "FULL", 0)
    monkeypatch.setattr(KeyBuckets, "_as_met", lambda *a: aligned.append(1) or original(*a))
    got = loaded(spark, snapshots, close_missing)
    assert aligned == [1, 1]
    assert got[0] == expected[0] == [1, 2, 2]  # the same again adds no run
    assert got[2] == expected[2] and got[1].counts(spark) == expected[1].counts(spark)


def test_hashes_that_are_not_shuffled_come_back(spark):
    _, store, _ = loaded(spark, [sales(spark, 100), sales(spark, 100, "3")])
    told = record_hash(["k", "line", "price", "note"], NULL_TOKEN)
    assert store.history(spark).filter(F.col(HASH) != told).isEmpty()
    # an odd hash, of another form than this load's, stays as it was written
    odd = scd2_stage(sales(spark, 100), ["k", "line"], ["price", "note"], "2024-05-01")
    store.load(odd.withColumn(HASH, F.lit("odd")), "2024-05-01")
    load_history(spark, sales(spark, 10, "8"), store, ["k", "line"], ["price", "note"], "2024-06-01")
    got = store.history(spark)
    assert got.filter(f"{HASH} = 'odd' AND NOT current_flag").count() == 10
    assert got.filter(f"{HASH} = 'odd' AND current_flag").count() == 90


def test_rows_that_change_while_they_are_loaded_end_the_load(spark, monkeypatch):
    monkeypatch.setattr(buckets, "FULL", 0)
    monkeypatch.setattr(buckets.KeyBuckets, "_as_met", lambda self, new, dates, f=KeyBuckets._as_met: f(self, new, {}))
    with pytest.raises(Exception, match="changed while they were loaded"):
        loaded(spark, [sales(spark, 100), sales(spark, 100, "3")])


@pytest.mark.parametrize("dated_by", [None, "day"])
def test_a_bucket_is_not_one_task_s(spark, unmerged, monkeypatch, dated_by):
    dealt = []
    original = buckets.splice

    def spy(rows, *args):
        dealt.append(rows.select(F.spark_partition_id().alias("p")).distinct().count())
        return original(rows, *args)

    monkeypatch.setattr(buckets, "splice", spy)
    store = KeyBuckets(scratch_dir(spark), ["k"], 1)
    rows = spark.range(400).selectExpr("id % 200 as k", "id % 7 as a", "date_add(date '2024-01-01', cast(id % 9 as int)) as day")
    for part in range(2):
        load_history(spark, rows.filter(f"id % 2 = {part}") if dated_by else rows, store, ["k"], ["a"], "2024-01-01", dated_by=dated_by)
    assert min(dealt) == 4  # the session's shuffle partitions


@pytest.mark.parametrize("most", [500_000, 0])
def test_distinct_by_hashes_is_distinct(spark, monkeypatch, most):
    monkeypatch.setattr(dedup, "REPEATED", most)
    rows = spark.range(60).selectExpr("id % 50 as a", "if(id % 7 = 0, null, 'x') as b", "if(id % 2 = 0, 0.0D, -0.0D) as c")
    rows = materialize(rows.union(rows.filter("a = 3")).union(spark.sql("SELECT cast(null as bigint), null, null FROM range(3)")))
    same = lambda df: sorted(map(str, df.collect()))
    got = dedup.distinct_mostly(rows)
    assert same(got.withColumn("c", F.col("c") + 0.0)) == same(rows.dropDuplicates().withColumn("c", F.col("c") + 0.0))
    # rows without a copy are not shuffled
    alone = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]
    assert len(alone) == 1 and ("Union" in got._jdf.queryExecution().executedPlan().toString()) == bool(most)


def test_the_clean_table_is_made_without_shuffling_every_row(spark, monkeypatch):
    told = []
    monkeypatch.setattr(jobs, "distinct_mostly", lambda df: told.append(1) or dedup.distinct_mostly(df))
    rows = spark.range(30).selectExpr(*[
        f"'2024-01-0{1 + i % 9}' as {c}" if "date" in c else f"string(id % 20) as {c}" for i, c in enumerate(ORDERS.names)
    ])
    schema = queries._new_schema(spark, "own")
    names = jobs.MedallionTables(*[f"{schema}.{t}" for t in ("bronze", "clean", "silver", "log")])
    jobs.medallion_job(spark, queries._csv(rows), names, as_of="2024-03-01 06:00:00")
    assert spark.table(names.silver).count() == 20 and told == [1]


@pytest.mark.parametrize("hashes", ["md5(string(id))", "if(id % 2 = 0, 'ABC', '')", "cast(null as string)", "'abc'"])
def test_tables_shuffle_hashes_as_bytes_and_keep_them(spark, hashes):
    rows = spark.range(20).selectExpr("id as k", f"{hashes} as {HASH}")
    dealt = HistoryTable("none", ["k"], 3)._by_bucket(rows)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    assert dealt.columns == rows.columns and "unhex" in dealt._jdf.queryExecution().analyzed().toString()


def test_what_is_written_is_compressed(spark):
    rows = spark.range(5000).selectExpr("id", "md5(string(id)) as h")
    assert all(f.endswith(".csv.gz") for f in spark.read.text(queries._csv(rows)).inputFiles())
    assert all(".zstd." in f for f in materialize(rows).inputFiles())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
