"""Time the headline queries; prints one JSON line.

``queries`` are ours. ``multi_pass`` times the same work done one action after another, the shape
the single-pass forms replace: a job per check, a compare, a count, a close and an append per
history load, and a filter and a count per side of a split. Each time is the best of
``BENCH_RUNS`` runs (default 2), after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarnkeep.fixtures import SECOND_LOAD, orders_like  # noqa: E402
from tarnkeep.functions.predicates import is_blank, not_matching, out_of_range  # noqa: E402
from tarnkeep.operators import quality, rules, scd2  # noqa: E402
from tarnkeep.plans.tables import SALES_HISTORY  # noqa: E402
from tarnkeep.session import scratch_dir, tune  # noqa: E402
from tarnkeep.suite import queries as suite  # noqa: E402

HEADLINE = (
    "measures_core", "measures_by_dim", "measures_by_channel", "measures_status",
    "repeat_customers", "top_products", "sales_ytd_mtd", "sales_last_12m",
    "sales_calendar_by_region", "orders_good", "orders_bad", "orders_violation_counts",
    "orders_dedup", "duplicate_rows", "contract_casts", "bronze_to_silver", "text_clean",
    "dq_report", "column_cardinality", "scd2_first_load", "scd2_second_load", "scd2_changes",
    "scd2_counts", "promo_scd2", "profile_a", "json_items", "json_items_fallback",
    "json_items_inferred", "csv_contract", "medallion_job", "cleansing_job_clean",
    "sales_history_job", "quality_job", "sales_history_dated", "sales_calendar_by_customer",
    "dq_report_states", "measures_appended", "profile_csv_states", "csv_mixed_headers",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action: Callable[[], None], runs: int) -> float:
    times = []
    while len(times) < runs:
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def checks_one_by_one(spark: SparkSession, sf: str) -> None:
    df = orders_like(spark, sf, suite._CHECKED)
    df.count()
    for check in suite.LINE_CHECKS:
        kind, column = check["type"], check.get("column")
        if kind == "row_count_gt":
            df.count()
        elif kind == "null_pct_lt" and "threshold" in check:
            df.count()
            df.filter(is_blank(F.col(column))).count()
        elif kind in ("unique_keys", "no_duplicate_keys"):
            df.select(*check["columns"]).distinct().count()
        elif kind == "value_range" and column in df.columns:
            df.filter(out_of_range(F.col(column), check.get("min"), check.get("max"))).count()
        elif kind == "regex":
            df.filter(not_matching(F.col(column), check["pattern"])).count()


def split_one_by_one(spark: SparkSession, sf: str) -> None:
    good, bad = rules.split(orders_like(spark, sf), rules.order_rules())
    bad.count()
    good.count()
    run(good)
    run(bad)


def history_action_by_action(history: DataFrame, staged: DataFrame) -> None:
    keys = list(SALES_HISTORY.keys)
    changed = scd2.scd2_changes(scd2.current_rows(history), staged, keys)
    changed.count()
    ids = changed.select(*keys).distinct().withColumn("changed", F.lit(True))
    closing = F.col("changed") & F.col("current_flag")
    updated = history.join(ids, keys, "left").withColumns({
        "effective_end_date": F.when(closing, F.lit(SECOND_LOAD).cast("date")).otherwise(
            F.col("effective_end_date")
        ),
        "current_flag": F.col("current_flag") & ~F.coalesce(closing, F.lit(False)),
    })
    run(updated)
    run(changed)
    history.filter("current_flag").count()
    history.count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or list(HEADLINE)
    shared = tempfile.mkdtemp(prefix="tarnkeep-bench-")
    spark = tune(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.checkpoint.dir", f"{shared}/scratch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    run(suite.QUERIES["measures_by_category"](spark, sf_dir))

    timed = {
        name: best(lambda q=suite.QUERIES[name]: run(q(spark, sf_dir)), runs) for name in names
    }
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if not sys.argv[1:]:
        # both sides of the history comparison read the same saved tables
        saved = {}
        for number in (1, 2):
            path = scratch_dir(spark)
            suite._staged_sales(spark, sf_dir, number).write.parquet(path)
            saved[number] = spark.read.parquet(path)
        result["single_pass"] = {
            "checks": best(lambda: run(quality.run_checks(
                orders_like(spark, sf_dir, suite._CHECKED), suite.LINE_CHECKS)), runs),
            "split": best(lambda: run(rules.annotate(
                orders_like(spark, sf_dir), rules.order_rules())), runs),
            "history": best(lambda: run(scd2.scd2_apply(
                saved[1], saved[2], SALES_HISTORY.keys, SECOND_LOAD)), runs),
        }
        result["multi_pass"] = {
            "checks": best(lambda: checks_one_by_one(spark, sf_dir), runs),
            "split": best(lambda: split_one_by_one(spark, sf_dir), runs),
            "history": best(lambda: history_action_by_action(saved[1], saved[2]), runs),
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
