from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import plans
from tarnkeep.plans import calendar
from tarnkeep.plans.calendar import date_dimension, join_calendar, sales_calendar
from tarnkeep.plans.measures import (
    MEASURES, control_measures, history_measures, measures, promotion_measures, top_products,
)

SALES = """select order_id, customer_id, product_name, cast(quantity as int) quantity,
    cast(unit_price as decimal(10,2)) unit_price, discount_pct,
    cast(total_amount as decimal(10,2)) total_amount, order_status
    from values
    ('o1', 'c1', 'pen', 2, 3.00, 10, 6.00, 'Shipped'),
    ('o1', 'c1', 'ink', 1, 5.00, 0, 5.00, 'returned'),
    ('o2', 'c1', 'pen', 1, 3.00, 0, 3.00, 'CANCELLED'),
    ('o3', null, 'pen', 4, 3.00, 5, 12.00, 'shipped'),
    ('o4', null, 'ink', 1, 5.00, 0, 5.00, null),
    ('o5', 'c2', 'ink', 1, null, null, 5.00, 'shipped')
    t(order_id, customer_id, product_name, quantity, unit_price, discount_pct, total_amount, order_status)"""

EXPECTED = {
    "Total Sales": Decimal("36.00"), "Total Quantity": 10, "Total Orders": 5,
    "Total Customers": 3, "Average Order Value": 7.2, "Average Quantity per Order": 2.0,
    "Average Unit Price": 3.8, "Total Discount Amount": Decimal("1.2000"),
    "Average Discount %": 3.0, "Shipped Orders": 3, "Cancelled Orders": 1,
    "Fulfillment Rate": 0.6, "Cancel Rate": 0.2, "Orders per Customer": 5 / 3,
    "Repeat Customers": 2,
}


@pytest.fixture(scope="module")
def sales(spark):
    return spark.sql(SALES)


def test_all_at_once(sales):
    row = measures(sales).first()
    assert {n: row[c] for n, c in MEASURES.items()} == EXPECTED


@pytest.mark.parametrize("name", list(MEASURES))
def test_each_alone(sales, name):
    assert measures(sales, [name]).first()[0] == EXPECTED[name]


def test_null_order_beside_another_makes_a_repeat_customer(spark):
    df = spark.sql("select * from values (null, 'a'), ('1', 'a'), (null, 'b'), (null, 'b') t(order_id, customer_id)")
    assert measures(df, ["Repeat Customers", "Total Orders"]).first() == (1, 2)


def test_by_dims(sales):
    rows = measures(sales, ["Total Orders", "Total Customers"], ["product_name"]).collect()
    assert {tuple(r) for r in rows} == {("pen", 3, 2), ("ink", 3, 3)}
    own = measures(sales, ["Shipped Orders", "Total Orders"], ["order_status"]).collect()
    assert (None, 0, 1) in {tuple(r) for r in own} and ("shipped", 2, 2) in {tuple(r) for r in own}
    keyed = measures(sales, ["Total Orders"], ["customer_id"]).collect()
    assert {tuple(r) for r in keyed} == {("c1", 2), ("c2", 1), (None, 2)}


def test_empty_table_and_unknown_name(sales):
    row = measures(sales.filter("false"), ["Total Orders", "Average Order Value", "Total Sales"]).first()
    assert tuple(row) == (0, None, None)
    with pytest.raises(ValueError, match="Profit"):
        measures(sales, ["Profit"])


def test_no_distinct_aggregate_is_planned(sales):
    plan = plans.physical(measures(sales, None, ["product_name"]))
    assert "distinct" not in plan.lower()
    assert plan.count("Exchange") == 2


def test_top_products(sales):
    assert [tuple(r) for r in top_products(sales, 2).collect()] == [
        ("pen", Decimal("21.00")), ("ink", Decimal("15.00")),
    ]
    tied = sales.withColumn("total_amount", sales.total_amount * 0)
    assert top_products(tied, 1).first()["product_name"] == "ink"
    assert "TakeOrderedAndProject" in plans.physical(top_products(sales, 2))


def test_promotions_and_histories(spark):
    history = spark.sql("""select * from values (1, 10.0D, false), (1, 20.0D, true),
        (2, null, true), (null, 30.0D, true), (3, 40.0D, false)
        t(promotion_id, discount_pct, current_flag)""")
    assert tuple(promotion_measures(history).first()) == (3, 25.0, 5)
    assert tuple(promotion_measures(history.filter("false")).first()) == (0, None, 0)
    assert tuple(history_measures(history).first()) == (3, 5)


def test_control(spark):
    control = spark.sql("""select Table_name, cast(n as decimal(18,4)) Table_count,
        timestamp(t) count_timestamp from values ('a', 1, '2024-01-01'), ('a', 5, '2024-01-03'),
        ('b', 7, '2024-01-03'), ('b', null, '2024-01-04') v(Table_name, n, t)""")
    row = control_measures(control).first()
    assert (str(row.latest_etl_run), row.quality_check_rows, row.latest_table_count) == (
        "2024-01-04 00:00:00", 4, Decimal("7.0000"),
    )
    assert control_measures(control, "a").first().latest_table_count == Decimal("5.0000")


def brute_force(totals, first, last):
    def total(days):
        found = [totals[d] for d in days if d in totals]
        return sum(found) if found else None

    def a_year_before(day):
        return day.replace(year=day.year - 1, day=28 if (day.month, day.day) == (2, 29) else day.day)

    for n in range((last - first).days + 1):
        d = first + timedelta(n)
        upto = [first + timedelta(i) for i in range(n + 1)]
        yield (
            d, totals.get(d), total([x for x in upto if x.year == d.year]),
            total([x for x in upto if (x.year, x.month) == (d.year, d.month)]),
            total([x for x in upto if x > a_year_before(d)]), totals.get(a_year_before(d)),
        )


def test_calendar_measures_against_brute_force(spark):
    sold = {
        date(2019, 2, 27): 1, date(2019, 2, 28): 2, date(2019, 3, 1): 4, date(2019, 12, 31): 8,
        date(2020, 2, 28): 16, date(2020, 2, 29): 32, date(2020, 3, 1): 64, date(2021, 2, 28): 128,
        date(2022, 5, 5): 256,
    }
    df = spark.createDataFrame(
        [(g, d, Decimal(v)) for d, v in sold.items() for g in ("x", None)],
        "g string, order_date date, total_amount decimal(10,2)",
    )
    expected = list(brute_force(sold, min(sold), max(sold)))
    got = sales_calendar(df.filter("g = 'x'")).orderBy("date").collect()
    assert [tuple(r) for r in got] == expected
    by_group = sales_calendar(df, ["g"]).filter("g is null").drop("g").orderBy("date").collect()
    assert [tuple(r) for r in by_group] == expected


def test_groups_share_the_whole_date_range(spark):
    df = spark.sql("""select g, date(d) order_date, cast(1 as decimal(10,2)) total_amount
        from values ('x', '2024-01-01'), ('y', '2024-01-03') t(g, d)""")
    days = sales_calendar(df, ["g"])
    assert days.count() == 6
    assert [r.sales_ytd for r in days.filter("g = 'y'").orderBy("date").collect()] == [
        None, None, Decimal("1.00"),
    ]


def test_measures_on_sold_and_on_given_days(spark):
    sold = {
        date(2019, 2, 28): 2, date(2020, 2, 29): 32, date(2020, 3, 1): 64, date(2021, 2, 28): 128,
        date(2024, 1, 1): 1, date(2024, 12, 31): 7,
    }
    df = spark.createDataFrame(
        [(g, d, Decimal(v)) for d, v in sold.items() for g in ("x", None)],
        "g string, order_date date, total_amount decimal(10,2)",
    )
    expected = {r[0]: r for r in brute_force(sold, min(sold), max(sold))}
    got = sales_calendar(df, ["g"], days="sold")
    for group in ("g = 'x'", "g is null"):
        assert [tuple(r)[1:] for r in got.filter(group).orderBy("date").collect()] == [
            expected[d] for d in sorted(sold)
        ]
    asked = [date(2020, 2, 28), date(2020, 2, 29), date(2021, 2, 28), date(2021, 3, 1), date(2023, 5, 5),
             date(2024, 1, 1), date(2024, 6, 30)]
    points = spark.createDataFrame([(None, d) for d in asked] + [("new", asked[0])], "g string, date date")
    at = sales_calendar(df, ["g"], days=points).orderBy("date").collect()
    assert [tuple(r)[1:] for r in at if r.g is None] == [expected[d] for d in asked]
    assert [tuple(r)[2:] for r in at if r.g == "new"] == [(None,) * 5]


def test_a_stray_date_costs_no_days(spark):
    df = spark.sql("""select g, date(d) order_date, cast(1 as decimal(10,2)) total_amount
        from values ('x', '1900-01-01'), ('y', '2024-01-03') t(g, d)""")
    steps = calendar._steps(calendar._events(calendar.day_totals(df, ["g"]), ["g"]), ["g"])
    assert steps.count() == 5  # the sale, new year's day and a year later, which are one day for x
    assert sales_calendar(df, ["g"], days="sold").count() == 2


def test_calendar_by_dimension_has_no_join(sales):
    dated = sales.withColumn("order_date", F.lit("2024-01-01").cast("date"))
    days = sales_calendar(dated, ["order_status"], days="sold")
    assert plans.count(days, "SortMergeJoin") + plans.count(days, "BroadcastHashJoin") == 0
    assert plans.count(days, "Exchange") == 2
    assert plans.count(sales_calendar(dated, ["order_status"]), "SortMergeJoin") == 0


def test_date_dimension(spark):
    df = spark.sql("select date'2023-12-30' order_date union all select date'2024-01-02'")
    days = date_dimension(df)
    assert days.count() == 4
    assert tuple(days.orderBy("date").first()) == (date(2023, 12, 30), 2023, 4, 12, 30)
    assert join_calendar(df, days).select("quarter").distinct().count() == 2


def test_no_window_spans_the_whole_table(sales):
    dated = sales.withColumn("order_date", F.lit("2024-01-01").cast("date"))
    plan = plans.physical(sales_calendar(dated))
    for line in plan.splitlines():
        if " Window " in line:
            assert "year" in line
