"""The test tables mapped to the shapes the operators work on.

The test tables have no nulls and few bad rows, so defects are put in by modulo on a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.dedup import first_per_key
from tarnkeep.plans.tables import PROMOTIONS, SALES

FIRST_LOAD, SECOND_LOAD = "2024-01-01", "2024-02-01"
LOGGED_AT = "2024-03-01 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# order column -> expression over the joined tables
_ORDER_COLUMNS = {
    "order_id": "l_orderkey",
    "customer_id": "case when l_orderkey % 97 = 0 then null else o_custkey end",
    "customer_name": "c_name",
    "email": "email",
    "region": "r_name",
    "order_date": "cast(o_orderdate as date)",
    "product_category": "p_type",
    "product_name": "p_name",
    "quantity": "cast(l_quantity as int) * case when l_orderkey % 89 = 0 then 0 else 1 end",
    "unit_price": "price",
    "discount_pct": "cast(round(l_discount * 100) as int)",
    "total_amount": (
        "cast(cast(l_quantity as int) * price"
        " + case when l_linenumber = 7 then 1 else 0 end as decimal(10,2))"
    ),
    "sales_channel": "o_orderpriority",
    "payment_method": "l_returnflag",
    "order_status": "o_orderstatus",
    "ship_date": "cast(l_shipdate as date)",
    "shipping_zip": "lpad(cast(o_custkey % 100000 as string), 5, '0')",
}
_OF_CUSTOMER = {"customer_name", "email", "region"}
_OF_PART = {"product_category", "product_name", "unit_price", "total_amount"}


def orders_like(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Order lines with their customer, region and product.

    Every line has its order, customer and part, so only the tables the wanted columns need are
    joined. Customers are attached to the shorter orders table before it meets the lines, and
    what depends on one table alone is worked out there.
    """
    wanted = list(_ORDER_COLUMNS) if columns is None else list(columns)
    orders = table(spark, sf_dir, "orders")
    if _OF_CUSTOMER & set(wanted):
        places = table(spark, sf_dir, "nation").join(
            table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
        )
        customers = table(spark, sf_dir, "customer").selectExpr(
            "c_custkey", "c_name", "c_nationkey",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') as email",
        ).join(places, F.expr("c_nationkey = n_nationkey"))
        orders = orders.join(customers, F.expr("o_custkey = c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    if _OF_PART & set(wanted):
        parts = table(spark, sf_dir, "part").selectExpr(
            "p_partkey", "p_name", "p_type", "cast(p_retailprice as decimal(10,2)) as price"
        )
        lines = lines.join(parts, F.expr("l_partkey = p_partkey"))
    return lines.select(*[F.expr(_ORDER_COLUMNS[c]).alias(c) for c in wanted])


def sales_snapshot_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sales file: one line per transaction and line number."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.expr("l_orderkey = o_orderkey"),
    )
    unique = first_per_key(
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    )
    return unique.selectExpr(
        "l_orderkey as transaction_id",
        "l_linenumber as line_number",
        "cast(l_shipdate as date) as transaction_date",
        "l_suppkey as store_id",
        "l_partkey as sku",
        "o_custkey as customer_id",
        "cast(round(l_discount * 100) as bigint) as promotion_id",
        "cast(l_quantity as int) as quantity_sold",
    ).select(*SALES.names)


def sales_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second sales file: some lines gone, some changed, some new."""
    return later_sales(sales_snapshot_1(spark, sf_dir))


def later_sales(first: DataFrame) -> DataFrame:
    """The second sales file out of the rows of the first."""
    later = (
        first.filter("transaction_id % 25 <> 1")
        .withColumn(
            "quantity_sold",
            F.expr("quantity_sold + case when transaction_id % 10 = 0 then 1 else 0 end"),
        )
    )
    shifts = F.expr(
        "case when transaction_id % 50 = 0 then array(0L, 1000000000L) else array(0L) end"
    )
    return (
        later.withColumn("shift", F.explode(shifts))
        .withColumn("transaction_id", F.expr("transaction_id + shift"))
        .select(*SALES.names)
    )


def promotions_snapshot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """The first or second promotion file; the second has other discounts for some."""
    raised = "case when p_partkey % 10 = 0 then 5 else 0 end" if number == 2 else "0"
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as promotion_id",
        "p_name as promotion_name",
        "p_type as promotion_type",
        f"cast(p_size + {raised} as double) as discount_pct",
        "date_add(date '2024-01-01', p_size) as start_date",
        "date_add(date '2024-01-01', p_size + 30) as end_date",
    ).select(*PROMOTIONS.names)


def api_pages(
    spark: SparkSession, sf_dir: str, size: int = 100, wrapper: str = "data"
) -> DataFrame:
    """Events as response bodies of ``size`` records, under ``data.items`` or a plain key."""
    record = F.struct(
        "event_id", "user_id", "event_type", "value",
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)").alias("ts_micros"),
        F.from_json("props", "struct<k bigint>").alias("props"),
    )
    pages = (
        table(spark, sf_dir, "events")
        .withColumn("page", F.expr(f"event_id div {size}"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(record)).alias("items"))
    )
    if wrapper == "data":
        body = F.struct(
            F.struct("items").alias("data"),
            F.concat(F.lit("/events?page="), F.col("page") + 1).alias("next"),
        )
    else:
        body = F.struct(
            F.struct(F.lit(size).alias("size")).alias("meta"), F.col("items").alias(wrapper)
        )
    return pages.select("page", F.to_json(body).alias("body"))


def control_rows(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    ),
) -> DataFrame:
    """Control rows: the row count of each test table, logged an hour apart."""
    entries = None
    for hour, name in enumerate(names):
        entry = table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("Table_name"),
            F.col("n").cast("decimal(18,4)").alias("Table_count"),
            F.expr(f"timestamp '{LOGGED_AT}' + interval {hour} hour").alias("count_timestamp"),
        )
        entries = entry if entries is None else entries.unionByName(entry)
    return entries
