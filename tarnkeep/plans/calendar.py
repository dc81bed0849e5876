"""The date dimension and the measures that run along it, at day grain.

Facts are summed per day before anything else. The measures then are step functions, which change
only where a day with sales comes into a period or leaves it: a handful of events per such day. Events are
dealt by dimension value and year, and running totals over them give every measure; there is no
join of days with days, and no row for a day on which nothing changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnkeep.session import materialize

_MONEY = "decimal(38,2)"


def date_dimension(df: DataFrame, column: str = "order_date") -> DataFrame:
    """Every day from the first to the last date of ``column``, with its calendar parts."""
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    return _with_parts(days)


def _with_parts(days: DataFrame) -> DataFrame:
    return days.select(
        "*",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


def join_calendar(
    facts: DataFrame, calendar: DataFrame, column: str = "order_date", how: str = "inner"
) -> DataFrame:
    """Facts with the calendar parts of their date. The calendar is bounded by the date range."""
    return facts.join(calendar, facts[column] == calendar["date"], how)


def day_totals(df: DataFrame, dims: Sequence[str] = (), column: str = "order_date") -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*dims, F.col(column).alias("date"))
        .agg(
            F.sum("total_amount").cast(_MONEY).alias("sales"),
            F.count("total_amount").alias("lines"),
        )
    )


def _events(totals: DataFrame, dims: Sequence[str]) -> DataFrame:
    """What each day with sales adds to the measures, and on which days.

    Its sales enter the last 12 months on the day and leave them a year later. Totals start
    anew each year, so they are carried into the next one on its first day. They are last
    year's sales a year later, also on 29 February if the day is 28 February.
    """
    day, year_on = F.col("date"), F.add_months("date", 12)
    day_after = F.date_add(year_on, 1)
    looks_back = lambda d: F.add_months(d, -12) == day
    leaves = F.when(F.add_months(year_on, -12) >= day, year_on).otherwise(day_after)
    new_year = F.make_date(F.year("date") + 1, F.lit(1), F.lit(1))
    none, no_lines = F.lit(None).cast(_MONEY), F.lit(None).cast("bigint")

    def event(on: Column, own: bool = False, sign: int = 0, last_year: bool = False) -> Column:
        return F.struct(
            on.alias("date"),
            (F.col("sales") if own else none).alias("sales"),
            (F.col("lines") if own else no_lines).alias("lines"),
            (F.col("sales") * sign if sign else none).cast(_MONEY).alias("step"),
            (F.col("lines") * sign if sign else no_lines).alias("step_lines"),
            (F.col("sales") if last_year else none).alias("ly"),
        )

    all_events = F.array(
        event(day, own=True, sign=1), event(new_year, sign=1), event(leaves, sign=-1),
        event(F.when(looks_back(year_on), year_on), last_year=True),
        event(F.when(looks_back(day_after), day_after), last_year=True),
    )
    dated = F.filter(all_events, lambda e: e["date"].isNotNull())
    return totals.select(*dims, F.inline(dated)).withColumn("asked", F.col("lines").isNotNull())


def _asked(points: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Days at which the measures are wanted, as events that change nothing."""
    return points.select(
        *dims, F.col("date").cast("date").alias("date"),
        *(F.lit(None).cast(_MONEY).alias(c) for c in ("sales", "step", "ly")),
        *(F.lit(None).cast("bigint").alias(c) for c in ("lines", "step_lines")),
        F.lit(True).alias("asked"),
    )


def _steps(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The measures on each day with an event, and the next such day of the year."""
    year = F.year("date").alias("year")
    # one exchange: the grouping by day and the windows all keep to (dims, year)
    dealt = events.select("*", year).repartition(*dims, "year")
    days = dealt.groupBy(*dims, "year", "date").agg(
        *(F.sum(c).cast(_MONEY).alias(c) for c in ("sales", "step", "ly")),
        *(F.sum(c).alias(c) for c in ("lines", "step_lines")), F.max("asked").alias("asked"),
    )
    in_year = Window.partitionBy(*dims, "year").orderBy("date")
    so_far = in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month_so_far = Window.partitionBy(*dims, "year", F.month("date")).orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    within = F.sum("step_lines").over(so_far) > 0
    return days.select(
        *dims, "year", "date", "asked", "sales",
        F.sum("sales").over(so_far).cast(_MONEY).alias("sales_ytd"),
        F.sum("sales").over(month_so_far).cast(_MONEY).alias("sales_mtd"),
        F.when(within, F.coalesce(F.sum("step").over(so_far), F.lit(0)).cast(_MONEY)).alias("sales_last_12m"),
        F.col("ly").alias("sales_same_period_ly"),
        F.lead("date").over(in_year).alias("next"),
    )


MEASURES = ("sales", "sales_ytd", "sales_mtd", "sales_last_12m", "sales_same_period_ly")


def _every_day(totals: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The measures on every day of the whole range, for each dimension value."""
    first, last = totals.agg(F.min("date")).scalar(), totals.agg(F.max("date")).scalar()
    # every year has its first day, so that each day follows an event
    values = totals.select(*dims).distinct() if dims else totals.agg(F.count("*").alias("n")).filter("n > 0")
    bounded = values.select(*dims, first.alias("first"), last.alias("last"))
    years = bounded.select(*dims, F.explode(
        F.sequence(F.trunc("first", "year"), F.trunc("last", "year"), F.expr("interval 1 year"))
    ).alias("date"))
    steps = _steps(_events(totals, dims).unionByName(_asked(years, dims)), dims)
    bound = steps.select("*", first.alias("first"), last.alias("last")).filter("date <= last")
    end = F.least(
        F.coalesce(F.date_sub("next", 1), F.make_date(F.col("year"), F.lit(12), F.lit(31))), F.col("last")
    )
    days = bound.withColumn("day", F.explode(F.sequence("date", end))).filter("day >= first")
    itself = F.col("day") == F.col("date")
    same_month = F.trunc("day", "month") == F.trunc("date", "month")
    shown = {"sales": itself, "sales_same_period_ly": itself, "sales_mtd": same_month}
    return days.select(*dims, F.col("day").alias("date"), *(
        (F.when(shown[m], F.col(m)) if m in shown else F.col(m)).alias(m) for m in MEASURES
    ))


def sales_calendar(
    df: DataFrame,
    dims: Sequence[str] = (),
    column: str = "order_date",
    days: str | DataFrame = "all",
) -> DataFrame:
    """Sales of each day with year-to-date, month-to-date, last 12 months and same day last year.

    The last 12 months are the days after the same day one year before, up to the day itself;
    29 February looks back to 28 February. A measure with no sale in its period is null.

    ``days`` tells for which days: ``all`` of the range for each dimension value, only those ``sold`` on,
    or those in a table of the dimensions and ``date``. The latter two cost no more than the days with
    sales and the days asked for, whatever the range.
    """
    dims = list(dims)
    totals = day_totals(df, dims, column)
    if isinstance(days, str) and days == "all":
        # written once: the range is needed beside the totals
        return _every_day(materialize(totals), dims)
    events = _events(totals, dims)
    if isinstance(days, DataFrame):
        events = events.withColumn("asked", F.lit(False)).unionByName(_asked(days, dims))
    elif days != "sold":
        raise ValueError(f"days are all, sold or a table, not {days}")
    return _steps(events, dims).filter("asked").select(*dims, "date", *MEASURES)
