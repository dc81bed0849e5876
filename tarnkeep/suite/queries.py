"""The registered queries: each maps (spark, folder of test tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep import fixtures
from tarnkeep.fixtures import FIRST_LOAD, LOGGED_AT, SECOND_LOAD, orders_like, table
from tarnkeep.functions.text import clean_identifier, clean_text
from tarnkeep.operators import (
    contracts, counts, dedup, profiling, quality, records, rules, scd2, states,
)
from tarnkeep.plans import calendar, jobs, measures
from tarnkeep.plans.grains import MeasureStore
from tarnkeep.plans.tables import (
    ORDER_DEDUP_KEYS, ORDERS, PROMOTION_HISTORY, SALES, SALES_HISTORY,
)
from tarnkeep.session import materialize, scratch_dir, tune
from tarnkeep.sinks.buckets import KeyBuckets
from tarnkeep.sinks.history import HistoryTable
from tarnkeep.sinks.states import PartStates
from tarnkeep.sinks.tables import ensure_schema
from tarnkeep.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query; its session gets the settings the operators count on."""

    @wraps(function)
    def tuned(spark: SparkSession, sf: str) -> DataFrame:
        return function(tune(spark), sf)

    QUERIES[function.__name__] = tuned
    return function


# ---- measures ----

CORE = [
    "Total Sales", "Total Quantity", "Total Orders", "Total Customers", "Average Order Value",
    "Average Quantity per Order", "Average Unit Price", "Total Discount Amount",
    "Average Discount %", "Orders per Customer",
]
STATUS = ["Shipped Orders", "Cancelled Orders", "Fulfillment Rate", "Cancel Rate"]
TEST_STATUSES = {"shipped": "F", "cancelled": "P"}
_CORE_COLUMNS = [
    "order_id", "customer_id", "quantity", "unit_price", "discount_pct", "total_amount",
]


@query
def measures_core(spark, sf):
    return measures.measures(orders_like(spark, sf, _CORE_COLUMNS), CORE)


@query
def measures_appended(spark, sf):
    """Measures kept over three loads, one of them sent twice."""
    lines = orders_like(spark, sf, _CORE_COLUMNS)
    store = MeasureStore(scratch_dir(spark), CORE, buckets=16)
    for part in (0, 1, 2, 1):
        store.append(lines.filter(f"abs(hash(quantity, unit_price, discount_pct)) % 3 = {part}"), f"load {part}")
    return store.measures(spark)


@query
def measures_by_dim(spark, sf):
    orders = orders_like(spark, sf, [*_CORE_COLUMNS, "region"])
    return measures.measures(orders, CORE, ["region"])


@query
def measures_by_category(spark, sf):
    orders = orders_like(spark, sf, ["product_category", "quantity", "total_amount"])
    return measures.measures(orders, ["Total Sales", "Total Quantity"], ["product_category"])


@query
def measures_by_channel(spark, sf):
    columns = [*_CORE_COLUMNS, "sales_channel", "order_status"]
    return measures.measures(
        orders_like(spark, sf, columns), None, ["sales_channel"], TEST_STATUSES
    )


@query
def measures_status(spark, sf):
    orders = orders_like(spark, sf, ["order_id", "customer_id", "order_status", "region"])
    return measures.measures(orders, [*STATUS, "Total Orders"], ["region"], TEST_STATUSES)


@query
def repeat_customers(spark, sf):
    orders = orders_like(spark, sf, ["order_id", "customer_id"])
    return measures.measures(orders, ["Repeat Customers", "Total Customers"])


@query
def top_products(spark, sf):
    return measures.top_products(orders_like(spark, sf, ["product_name", "total_amount"]), 10)


# ---- measures along the calendar ----

_DAY_COLUMNS = ["order_date", "total_amount"]


@query
def sales_ytd_mtd(spark, sf):
    days = calendar.sales_calendar(orders_like(spark, sf, _DAY_COLUMNS))
    return days.select("date", "sales", "sales_ytd", "sales_mtd")


@query
def sales_last_12m(spark, sf):
    days = calendar.sales_calendar(orders_like(spark, sf, _DAY_COLUMNS))
    return days.select("date", "sales_last_12m")


@query
def sales_same_period_ly(spark, sf):
    days = calendar.sales_calendar(orders_like(spark, sf, _DAY_COLUMNS))
    return days.select("date", "sales", "sales_same_period_ly")


@query
def sales_calendar_by_region(spark, sf):
    return calendar.sales_calendar(orders_like(spark, sf, [*_DAY_COLUMNS, "region"]), ["region"])


@query
def sales_calendar_by_customer(spark, sf):
    """All five measures for each customer, on the days they bought."""
    return calendar.sales_calendar(
        orders_like(spark, sf, [*_DAY_COLUMNS, "customer_id"]), ["customer_id"], days="sold"
    )


@query
def sales_by_quarter(spark, sf):
    ordered_on = table(spark, sf, "orders").selectExpr("cast(o_orderdate as date) as order_date")
    dated = calendar.join_calendar(
        orders_like(spark, sf, _DAY_COLUMNS), calendar.date_dimension(ordered_on)
    )
    return measures.measures(dated, ["Total Sales"], ["year", "quarter"])


# ---- row rules, casts and duplicates ----


@query
def orders_good(spark, sf):
    good, _ = rules.split(orders_like(spark, sf), rules.order_rules())
    return good


@query
def orders_bad(spark, sf):
    order_rules = rules.order_rules()
    _, bad = rules.split(orders_like(spark, sf), order_rules)
    named = rules.annotate(bad, order_rules)
    return named.withColumn("violations", F.array_join("violations", ","))


@query
def orders_violation_counts(spark, sf):
    return rules.violation_counts(orders_like(spark, sf), rules.order_rules())


@query
def orders_total_with_discount(spark, sf):
    """Rows breaking the rule whose expected total takes the discount off."""
    columns = ["order_id", "quantity", "unit_price", "discount_pct", "total_amount"]
    net = "quantity * unit_price * (100 - discount_pct) * 0.01BD"
    return orders_like(spark, sf, columns).filter(
        rules.Rule("total_inconsistent", f"total_amount <> {net}").broken
    )


@query
def orders_dedup(spark, sf):
    return dedup.first_per_key(orders_like(spark, sf), ORDER_DEDUP_KEYS)


@query
def orders_distinct(spark, sf):
    columns = ["order_id", "customer_id", "order_date", "order_status"]
    return dedup.distinct_rows(orders_like(spark, sf, columns))


@query
def orders_distinct_keys(spark, sf):
    return dedup.distinct_keys(orders_like(spark, sf, ["order_id", "discount_pct"]),
                               ["order_id", "discount_pct"])


@query
def duplicate_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return dedup.duplicate_row_count(lines)


_RAW_LINES = [
    "l_orderkey",
    "l_linenumber",
    "case when l_orderkey % 11 = 0 then 'n/a' when l_orderkey % 13 = 0 then concat(cast("
    "cast(l_quantity as int) as string), '.7') else cast(cast(l_quantity as int) as string) end"
    " as quantity",
    "case when l_orderkey % 7 = 0 then concat('x', l_returnflag) else "
    "cast(cast(l_extendedprice as decimal(12,2)) as string) end as price",
    "case when l_orderkey % 5 = 0 then '2024-13-01' when l_orderkey % 3 = 0 then '2024-1-2' else "
    "cast(cast(l_shipdate as date) as string) end as shipped",
]


@query
def contract_casts(spark, sf):
    """Text with broken numbers and dates through a contract."""
    contract = contracts.Contract({
        "l_orderkey": "BIGINT", "l_linenumber": "INT", "quantity": "INT",
        "price": "DECIMAL(10,2)", "shipped": "DATE",
    })
    return contracts.apply_contract(table(spark, sf, "lineitem").selectExpr(*_RAW_LINES), contract)


@query
def bronze_to_silver(spark, sf):
    columns = ["order_id", "customer_id", "order_date", "region", "order_status"]
    clean = jobs.clean_orders(orders_like(spark, sf, columns), as_of=LOGGED_AT)
    return clean.drop(jobs.LOAD_TIME)


@query
def clean_complete_columns(spark, sf):
    """Incomplete rows judged by named columns only; the load time is kept."""
    columns = ["order_id", "customer_id", "order_date", "order_status"]
    return jobs.clean_orders(
        orders_like(spark, sf, columns), complete=["orderid", "order_date"], as_of=LOGGED_AT
    )


@query
def text_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", clean_text(F.col("text")).alias("cleaned_text")
    )


@query
def identifier_clean(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", clean_identifier(F.concat_ws("-", "p_name", "p_brand")).alias("identifier")
    )


@query
def regex_flag(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(*_RAW_LINES)
    return rules.flag_regex(raw, "shipped", r"^\d{4}-\d{2}-\d{2}$").select(
        "l_orderkey", "l_linenumber", "shipped", "matches_regex"
    )


# ---- quality checks and counts ----


@query
def null_pct(spark, sf):
    orders = table(spark, sf, "orders").withColumn("status", F.expr("nullif(o_orderstatus, 'P')"))
    return quality.null_percentage(orders, "status")


@query
def distinct_keys(spark, sf):
    lines = orders_like(spark, sf, ["order_id", "customer_id"])
    return quality.distinct_count(lines, ["order_id", "customer_id"])


@query
def range_violations(spark, sf):
    return quality.value_range_violations(table(spark, sf, "customer"), "c_acctbal", 0, 9000)


@query
def regex_violations(spark, sf):
    return quality.regex_violations(table(spark, sf, "customer"), "c_name", r"^Customer#\d*[02468]$")


LINE_CHECKS = [
    {"type": "row_count_gt", "value": 0, "name": "not_empty"},
    {"type": "null_pct_lt", "column": "customer_id", "threshold": 1.0, "name": "customer_nulls"},
    {"type": "unique_keys", "columns": ["order_id"], "expected": 1, "name": "some_orders"},
    {"type": "unique_keys", "columns": ["order_id", "discount_pct"], "name": "some_pairs"},
    {"type": "no_duplicate_keys", "columns": ["order_id", "discount_pct"], "name": "pairs_once"},
    {"type": "value_range", "column": "quantity", "min": 1, "name": "quantity_positive"},
    {"type": "value_range", "column": "discount_pct", "min": 0, "max": 20, "name": "discount"},
    {"type": "regex", "column": "sales_channel", "pattern": "^[1-5]-", "name": "channel"},
    {"type": "regex", "column": "order_status", "pattern": "^[FO]$", "name": "status"},
    {"type": "null_pct_lt", "column": "order_id", "name": "no_threshold"},
    {"type": "value_range", "column": "amount", "min": 0, "name": "no_such_column"},
    {"type": "freshness", "name": "no_such_check"},
]
_CHECKED = [
    "order_id", "customer_id", "quantity", "discount_pct", "sales_channel", "order_status",
]


@query
def dq_report(spark, sf):
    return quality.run_checks(orders_like(spark, sf, _CHECKED), LINE_CHECKS, "order_lines")


def _grown(rows: DataFrame, by: str) -> tuple[str, Callable[[], None]]:
    """A folder with one half of the rows in folders by a column, and how the other half arrives."""
    target = scratch_dir(rows.sparkSession)
    write = lambda part: part.write.mode("append").partitionBy(by).parquet(target)
    write(rows.filter(f"abs(hash({by})) % 2 = 0"))
    return target, lambda: write(rows.filter(f"abs(hash({by})) % 2 = 1"))


@query
def dq_report_states(spark, sf):
    """The report on a folder that has grown, from its parts' states."""
    target, grow = _grown(orders_like(spark, sf, _CHECKED), "sales_channel")
    store = PartStates(scratch_dir(spark))
    for arrive in (lambda: None, grow):
        arrive()
        report = jobs.quality_states_job(spark, target, LINE_CHECKS, store, "order_lines")
    return report


@query
def distinct_states(spark, sf):
    """Exact distinct counts over keys and bitmaps, merged from the states of files."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_linenumber")
    target, grow = _grown(lines, "l_linenumber")
    store = PartStates(scratch_dir(spark))
    keys = {"pairs": ["l_orderkey", "l_partkey"], "dates": ["l_shipdate"]}
    dense = {"orders": "l_orderkey", "parts": "l_partkey"}
    for arrive in (lambda: None, grow):
        arrive()
        rows = store.refresh(
            spark, target, lambda df: states.states(df, keys=keys, dense=dense), "distinct", "file"
        )
    return states.merged(rows.filter("metric NOT LIKE '%|null'")).withColumnRenamed("value", "distinct_values")


CUSTOMER_CHECKS = [
    {"type": "row_count_gt", "value": 1000000, "name": "many"},
    {"type": "value_range", "column": "c_acctbal", "min": 0, "name": "no_debt"},
]


@query
def dq_config(spark, sf):
    """Two tables of one configuration."""
    table(spark, sf, "customer").createOrReplaceTempView("dq_customer")
    table(spark, sf, "supplier").createOrReplaceTempView("dq_supplier")
    return quality.run_config(spark, {"tables": [
        {"table": "dq_customer", "checks": CUSTOMER_CHECKS},
        {"table": "dq_supplier", "checks": [
            {"type": "no_duplicate_keys", "columns": ["s_suppkey"]},
        ]},
    ]})


@query
def column_cardinality(spark, sf):
    return counts.column_cardinality(table(spark, sf, "lineitem"))


@query
def category_counts(spark, sf):
    return counts.category_counts(orders_like(spark, sf, ["product_category"]), "product_category")


@query
def validation_counts(spark, sf):
    names = ["customer", "orders", "lineitem", "events"]
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(f"counted_{name}")
    return jobs.validation_counts(spark, [f"counted_{n}" for n in names])


# ---- histories ----


def _staged_sales(spark, sf, number):
    snapshot = fixtures.sales_snapshot_1 if number == 1 else fixtures.sales_snapshot_2
    return scd2.scd2_stage(
        snapshot(spark, sf), SALES_HISTORY.keys, SALES_HISTORY.tracked,
        FIRST_LOAD if number == 1 else SECOND_LOAD,
    )


def _second_history(spark, sf):
    return scd2.scd2_apply(
        _staged_sales(spark, sf, 1), _staged_sales(spark, sf, 2), SALES_HISTORY.keys, SECOND_LOAD
    )


@query
def scd2_first_load(spark, sf):
    return scd2.scd2_apply(None, _staged_sales(spark, sf, 1), SALES_HISTORY.keys, FIRST_LOAD)


@query
def scd2_second_load(spark, sf):
    return _second_history(spark, sf)


@query
def scd2_noop(spark, sf):
    """The same file loaded again: the history is unchanged."""
    again = scd2.scd2_stage(
        fixtures.sales_snapshot_1(spark, sf), SALES_HISTORY.keys, SALES_HISTORY.tracked,
        SECOND_LOAD,
    )
    return scd2.scd2_apply(_staged_sales(spark, sf, 1), again, SALES_HISTORY.keys, SECOND_LOAD)


@query
def scd2_close_missing(spark, sf):
    return scd2.scd2_apply(
        _staged_sales(spark, sf, 1), _staged_sales(spark, sf, 2), SALES_HISTORY.keys, SECOND_LOAD,
        close_missing=True,
    )


@query
def scd2_changes(spark, sf):
    return scd2.scd2_changes(
        _staged_sales(spark, sf, 1), _staged_sales(spark, sf, 2), SALES_HISTORY.keys
    )


@query
def scd2_counts(spark, sf):
    return scd2.scd2_counts(_second_history(spark, sf))


@query
def scd2_current(spark, sf):
    return scd2.current_rows(_second_history(spark, sf))


def _promotion_history(spark, sf):
    first, second = (
        scd2.scd2_stage(
            fixtures.promotions_snapshot(spark, sf, number), PROMOTION_HISTORY.keys,
            PROMOTION_HISTORY.tracked, as_of,
        )
        for number, as_of in ((1, FIRST_LOAD), (2, SECOND_LOAD))
    )
    return scd2.scd2_apply(first, second, PROMOTION_HISTORY.keys, SECOND_LOAD)


@query
def promo_scd2(spark, sf):
    return _promotion_history(spark, sf)


@query
def promotion_measures(spark, sf):
    return measures.promotion_measures(_promotion_history(spark, sf))


@query
def history_measures(spark, sf):
    return measures.history_measures(_second_history(spark, sf))


# ---- control table ----


@query
def etl_log(spark, sf):
    return fixtures.control_rows(spark, sf)


@query
def etl_latest(spark, sf):
    return measures.control_measures(fixtures.control_rows(spark, sf))


@query
def etl_top20(spark, sf):
    return counts.latest_entries(fixtures.control_rows(spark, sf), 20)


# ---- profiles ----


def _profiled(spark, sf):
    return {
        name: table(spark, sf, name)
        for name in ("orders", "lineitem", "documents", "events", "labels")
    }


@query
def profile_a(spark, sf):
    profiles = profiling.profile_tables(_profiled(spark, sf), "a")
    return profiles.select("table_name", "column", "sql_type", "filled")


@query
def profile_b(spark, sf):
    profiles = profiling.profile_tables(_profiled(spark, sf), "b")
    return profiles.select("table_name", "column", "sql_type", "filled")


@query
def profile_csv_states(spark, sf):
    """The profile of a CSV set that has grown by files with another column order."""
    sales = fixtures.sales_snapshot_1(spark, sf)
    target, store = scratch_dir(spark), PartStates(scratch_dir(spark))
    for part, columns in enumerate((sales.columns, sales.columns[::-1])):
        rows = sales.filter(f"transaction_id % 2 = {part}").select(*columns)
        rows.write.option("header", True).mode("append").csv(target)
        profiled = jobs.profile_states_job(spark, target, store, "a", "sales")
    return profiled.select("table_name", "column", "sql_type", "filled")


@query
def profile_ddl(spark, sf):
    return profiling.ddl(profiling.profile_tables(_profiled(spark, sf), "a"), "landing")


@query
def csv_definitions(spark, sf):
    """CSV with leading zeros, mixed types and blanks into table definitions."""
    key = F.col("o_orderkey")
    mixed = table(spark, sf, "orders").select(
        F.lpad(key.cast("string"), 12, "0").alias("padded"),
        F.when(key % 7 == 0, "n/a").otherwise(key.cast("string")).alias("mixed"),
        F.when(key % 3 != 0, key.cast("string")).alias("blanks"),
        F.when(key % 2 == 0, "true").otherwise("0").alias("flag"),
    )
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    sources = {"mixed_orders": _csv(mixed), "some_labels": _csv(labels)}
    return jobs.definitions_job(spark, sources, "landing")


# ---- API records ----

_EVENT = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props MAP<STRING, BIGINT>"


def _events_of(items: DataFrame) -> DataFrame:
    return records.items_to_table(items, _EVENT).select(
        "event_id", "user_id", "event_type", "value", F.col("props")["k"].alias("k")
    )


@query
def json_items(spark, sf):
    return _events_of(records.extract_items(fixtures.api_pages(spark, sf), "body", "data.items"))


@query
def json_items_fallback(spark, sf):
    """No records at the path: the first list of the body is taken."""
    pages = fixtures.api_pages(spark, sf, wrapper="records")
    return _events_of(records.extract_items(pages, "body", "data.items"))


@query
def json_items_inferred(spark, sf):
    """Columns and types found from the records themselves."""
    items = records.extract_items(fixtures.api_pages(spark, sf), "body", "data.items")
    inferred = records.items_to_table(materialize(items.select("item")))
    return inferred.select("*", F.col("props")["k"].alias("k")).drop("props")


@query
def json_rejects(spark, sf):
    """Bodies cut off before their end are kept apart."""
    key = F.col("event_id")
    bodies = table(spark, sf, "events").select("event_id", F.concat(
        F.lit('{"items":[{"id":'), key.cast("string"), F.when(key % 7 == 0, "").otherwise("}]}"),
    ).alias("body"))
    return records.body_rejects(bodies)


@query
def json_large_numbers(spark, sf):
    """Whole numbers beyond BIGINT keep every digit."""
    key = F.lpad((F.col("event_id") % 1000000).cast("string"), 6, "0")
    bodies = table(spark, sf, "events").select(
        F.concat(F.lit('[{"id":12345678901234'), key, F.lit("}]")).alias("body")
    )
    items = materialize(records.extract_items(bodies, "body", "items"))
    return records.items_to_table(items).select(F.col("id").cast("string").alias("id"))


@query
def json_deep_records(spark, sf):
    """Records nested three deep, one of their objects keyed by data: types are found by path."""
    props = F.from_json("props", "struct<k bigint>")
    odd = F.col("event_id") % 2 == 1
    record = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("id"), F.struct(
            F.col("event_type").alias("name"), F.array(F.col("user_id") % 3, props["k"]).alias("codes"),
        ).alias("kind")).alias("who"),
        F.array(
            F.struct(props["k"].alias("n"), F.when(odd, "odd").alias("label")),
            F.struct((F.col("event_id") % 5).alias("n"), F.lit("rest").alias("label")),
        ).alias("lines"),
        F.create_map(F.concat(F.lit("u"), "event_id"), F.struct("value", "event_type")).alias("by_id"),
    )
    bodies = table(spark, sf, "events").select(F.to_json(F.array(record)).alias("body"))
    items = materialize(records.extract_items(bodies, "body", "items"))
    found = records.items_to_table(items, most_keys=50)
    own = F.col("by_id")[F.concat(F.lit("u"), "id")]
    return found.select(
        "id", F.col("who.id").alias("user_id"), F.col("who.kind.name").alias("name"),
        F.col("who.kind.codes")[0].alias("code"), F.aggregate(
            "lines", F.lit(0).cast("long"), lambda s, x: s + x["n"]
        ).alias("n"),
        F.col("lines")[0]["label"].alias("label"), own["value"].alias("value"),
        own["event_type"].alias("event_type"), F.size("by_id").cast("long").alias("keys"),
    )


@query
def json_keyed_records(spark, sf):
    """Records whose keys are data make one map column."""
    entry = F.create_map(F.concat(F.lit("e"), "event_id"), F.col("user_id"))
    bodies = table(spark, sf, "events").select(F.to_json(F.array(entry)).alias("body"))
    items = materialize(records.extract_items(bodies, "body", "items"))
    found = records.items_to_table(items, most_keys=50)
    return found.select(F.explode("value").alias("key", "user_id"))


@query
def json_props(spark, sf):
    """A plain path into a text column: one record per event."""
    events = table(spark, sf, "events").select("event_id", "props")
    items = records.extract_items(events, "props", "")
    return items.select("event_id", F.try_variant_get("item", "$.k", "bigint").alias("k"))


# ---- whole jobs, through files and tables ----


def _csv(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession)
    df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


def _new_schema(spark: SparkSession, prefix: str) -> str:
    """A schema of its own for one run, kept in scratch."""
    location = scratch_dir(spark)
    name = f"{prefix}_{location.rsplit('-', 1)[1]}"
    ensure_schema(spark, name, location)
    return name


@query
def csv_contract(spark, sf):
    return files.read_csv(spark, _csv(orders_like(spark, sf)), ORDERS)


@query
def csv_mixed_headers(spark, sf):
    """Files of one set whose headers differ in order, one of them without two columns."""
    sales = fixtures.sales_snapshot_1(spark, sf)
    names = sales.columns
    target = scratch_dir(spark)
    for part, columns in enumerate((names, names[::-1], [c for c in names if c not in ("sku", "store_id")])):
        rows = sales.filter(f"transaction_id % 3 = {part}").select(*columns)
        rows.write.option("header", True).mode("append").csv(target)
    return files.read_csv(spark, target, SALES, by_name=True)


@query
def csv_rejects(spark, sf):
    """Lines with a field too many or two too few."""
    key = F.col("o_orderkey")
    line = F.concat(
        key.cast("string"),
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit(","), "o_orderstatus", F.lit(",x"))),
        F.when(key % 7 == 0, ",more").otherwise(""),
    )
    # the whole line is one column for the writer, whose own separator does not occur in it
    lines = table(spark, sf, "orders").select(line.alias("id,status,mark"))
    path = scratch_dir(spark)
    lines.write.option("header", True).option("sep", ";").csv(path)
    return files.csv_rejects(spark, path).select("id", "line")


@query
def medallion_job(spark, sf):
    schema = _new_schema(spark, "medallion")
    names = jobs.MedallionTables(*[f"{schema}.{t}" for t in ("bronze", "clean", "silver", "log")])
    jobs.medallion_job(spark, _csv(orders_like(spark, sf)), names, as_of=LOGGED_AT)
    return spark.table(names.silver)


@query
def medallion_log(spark, sf):
    """The control table after two runs of the job."""
    schema = _new_schema(spark, "log")
    names = jobs.MedallionTables(
        *[f"{schema}.{t}" for t in ("bronze", "clean", "silver", "log", "appended")]
    )
    source = _csv(orders_like(spark, sf))
    for day in ("2024-03-01 06:00:00", "2024-03-02 06:00:00"):
        jobs.medallion_job(spark, source, names, complete=["orderid"], as_of=day)
    log = jobs.latest_control_rows(spark, names.control).select(
        F.lit("logged").alias("entry"), "Table_count", "count_timestamp"
    )
    appended = counts.row_count_entry(spark.table(names.appended), "appended", LOGGED_AT).select(
        F.lit("appended").alias("entry"),
        F.col("table_count").cast("decimal(18,4)").alias("Table_count"),
        "count_timestamp",
    )
    return log.unionByName(appended)


def _cleansed(spark, sf):
    clean, bad = scratch_dir(spark), scratch_dir(spark)
    jobs.cleanse_orders_job(spark, _csv(orders_like(spark, sf)), clean, bad, as_of=LOGGED_AT)
    return files.read_path(spark, clean), files.read_path(spark, bad)


@query
def cleansing_job_clean(spark, sf):
    return _cleansed(spark, sf)[0]


@query
def cleansing_job_bad(spark, sf):
    bad = _cleansed(spark, sf)[1]
    return bad.withColumn("violations", F.array_join("violations", ","))


@query
def sales_history_job(spark, sf):
    """Two CSV loads, then the second again, which adds no run."""
    store = KeyBuckets(scratch_dir(spark), SALES_HISTORY.keys, 16)
    first = _csv(fixtures.sales_snapshot_1(spark, sf))
    second = _csv(fixtures.later_sales(files.read_csv(spark, first, SALES)))
    for source, as_of in ((first, FIRST_LOAD), (second, SECOND_LOAD), (second, "2024-03-01")):
        jobs.history_job(spark, source, store, SALES_HISTORY, as_of)
    return store.history(spark)


@query
def sales_history_tables(spark, sf):
    """The same loads into tables bucketed by the key."""
    schema = _new_schema(spark, "histories")
    store = HistoryTable(f"{schema}.sales", SALES_HISTORY.keys, 16)
    first = materialize(fixtures.sales_snapshot_1(spark, sf))
    loads = ((first, FIRST_LOAD), (fixtures.later_sales(first), SECOND_LOAD))
    for rows, as_of in loads:
        jobs.load_history(
            spark, rows, store, SALES_HISTORY.keys, SALES_HISTORY.tracked, as_of
        )
    return store.history(spark)


@query
def sales_history_dated(spark, sf):
    """Rows with dates of their own, many per key, in three loads that come in no order."""
    stated = table(spark, sf, "lineitem").selectExpr(
        "l_partkey as sku", "cast(round(l_discount * 100) as bigint) as discount_pct",
        "l_returnflag as flag", "cast(l_shipdate as date) as shipped",
    )
    store = KeyBuckets(scratch_dir(spark), ["sku"], 16)
    for part in (2, 0, 1):
        jobs.load_history(
            spark, stated.filter(f"unix_date(shipped) % 3 = {part}"), store, ["sku"],
            ["discount_pct", "flag"], FIRST_LOAD, dated_by="shipped", confirm=True,
        )
    return store.history(spark)


@query
def promotions_history_job(spark, sf):
    store = KeyBuckets(scratch_dir(spark), PROMOTION_HISTORY.keys, 16)
    for number, as_of in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        source = _csv(fixtures.promotions_snapshot(spark, sf, number))
        jobs.history_job(spark, source, store, PROMOTION_HISTORY, as_of)
    return store.current(spark)


@query
def quality_job(spark, sf):
    """The report of a configuration, written as JSON and read back."""
    orders_like(spark, sf, _CHECKED).createOrReplaceTempView("checked_lines")
    target = scratch_dir(spark)
    config = {"tables": [{"table": "checked_lines", "checks": LINE_CHECKS}]}
    jobs.quality_job(spark, config, target, run_date=FIRST_LOAD)
    written = spark.read.schema(quality.REPORT).json(target)
    return written.select(*quality.REPORT.names)
