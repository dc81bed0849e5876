"""The sales, customer, promotion, history and control measures.

Distinct counts count null as a value. Ratios are null when the divisor is zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measure names with their output columns, by the grain each is counted on.
ROW_MEASURES = {
    "Total Sales": "total_sales",
    "Total Quantity": "total_quantity",
    "Average Unit Price": "average_unit_price",
    "Total Discount Amount": "total_discount_amount",
    "Average Discount %": "average_discount_pct",
}
ORDER_MEASURES = {
    "Total Orders": "total_orders",
    "Average Order Value": "average_order_value",
    "Average Quantity per Order": "average_quantity_per_order",
    "Shipped Orders": "shipped_orders",
    "Cancelled Orders": "cancelled_orders",
    "Fulfillment Rate": "fulfillment_rate",
    "Cancel Rate": "cancel_rate",
}
CUSTOMER_MEASURES = {
    "Total Customers": "total_customers",
    "Repeat Customers": "repeat_customers",
}
BOTH_MEASURES = {"Orders per Customer": "orders_per_customer"}
MEASURES = ROW_MEASURES | ORDER_MEASURES | CUSTOMER_MEASURES | BOTH_MEASURES

# The order statuses the status measures look for.
STATUSES = {"shipped": "shipped", "cancelled": "cancelled"}

_MONEY = "decimal(38,2)"


def divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _percent_of(total: Column) -> Column:
    return (total.cast("decimal(34,2)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,4)")


def _status_is(value: str) -> Column:
    return F.lower("order_status") == value.lower()


def _row_parts(wanted: set[str]) -> dict[str, Column]:
    """Partial aggregates that can be summed again over any coarser grouping."""
    parts = {}
    if wanted & {"Total Sales", "Average Order Value"}:
        parts["amount"] = F.sum("total_amount")
    if wanted & {"Total Quantity", "Average Quantity per Order"}:
        parts["units"] = F.sum(F.col("quantity").cast("bigint"))
    if "Average Unit Price" in wanted:
        parts["prices"] = F.sum("unit_price")
        parts["priced"] = F.count("unit_price")
    if "Total Discount Amount" in wanted:
        parts["discount"] = F.sum("__discount")
    if "Average Discount %" in wanted:
        parts["percents"] = F.sum(F.col("discount_pct").cast("bigint"))
        parts["discounted"] = F.count("discount_pct")
    return parts


def _results(has: Mapping[str, Column]) -> dict[str, Column]:
    """Each measure over the totals in ``has``; measures whose totals are absent are left out."""
    formulas = {
        "Total Sales": (["amount"], lambda t: t.cast(_MONEY)),
        "Total Quantity": (["units"], lambda u: u),
        "Total Orders": (["orders"], lambda o: o),
        "Total Customers": (["customers"], lambda c: c),
        "Average Order Value": (["amount", "orders"], divide),
        "Average Quantity per Order": (["units", "orders"], divide),
        "Average Unit Price": (["prices", "priced"], divide),
        "Total Discount Amount": (["discount"], _percent_of),
        "Average Discount %": (["percents", "discounted"], divide),
        "Shipped Orders": (["shipped"], lambda s: s),
        "Cancelled Orders": (["cancelled"], lambda c: c),
        "Fulfillment Rate": (["shipped", "orders"], divide),
        "Cancel Rate": (["cancelled", "orders"], divide),
        "Orders per Customer": (["orders", "customers"], divide),
        "Repeat Customers": (["repeaters"], lambda r: r),
    }
    return {
        name: formula(*[has[i] for i in inputs])
        for name, (inputs, formula) in formulas.items()
        if all(i in has for i in inputs)
    }


#: How summaries of one order or customer merge, where they are not summed.
_MERGED = {"shipped": F.max, "cancelled": F.max, "lowest": F.min, "highest": F.max}
_OF_A_KEY = ("shipped", "cancelled", "lowest", "highest", "with_order", "lines")
NOT_ORDER = "__not_order"


class Grains:
    """The steps from rows to measures: summaries per order and customer, totals, measures.

    Summaries of one key merge, and totals of disjoint keys add up, so both can be kept and
    brought up to date without the rows they came from.
    """

    def __init__(
        self,
        names: Sequence[str] | None = None,
        dims: Sequence[str] = (),
        statuses: Mapping[str, str] = STATUSES,
    ) -> None:
        self.names = list(MEASURES) if names is None else list(names)
        unknown = [n for n in self.names if n not in MEASURES]
        if unknown:
            raise ValueError(f"unknown measures: {unknown}")
        wanted, self.dims = set(self.names), list(dims)
        self.by_order = bool(wanted & (set(ORDER_MEASURES) | set(BOTH_MEASURES)))
        self.by_customer = bool(wanted & (set(CUSTOMER_MEASURES) | set(BOTH_MEASURES)))
        self._parts = _row_parts(wanted)
        # worked out once per row, before rows are copied for a second grain
        self._derived = {}
        if "discount" in self._parts:
            units = F.col("quantity").cast("bigint") * F.col("discount_pct")
            self._derived["__discount"] = (units * F.col("unit_price")).cast("decimal(31,2)")
        if wanted & {"Shipped Orders", "Fulfillment Rate"}:
            self._derived["__shipped"] = _status_is(statuses["shipped"]).cast("int")
            self._parts["shipped"] = F.max("__shipped")
        if wanted & {"Cancelled Orders", "Cancel Rate"}:
            self._derived["__cancelled"] = _status_is(statuses["cancelled"]).cast("int")
            self._parts["cancelled"] = F.max("__cancelled")
        self.grains = [
            column
            for column, used in (("__order", self.by_order), ("__customer", self.by_customer))
            if used
        ]
        if "Repeat Customers" in wanted:
            self._parts["lowest"] = F.min("order_id")
            self._parts["highest"] = F.max("order_id")
            self._parts["with_order"] = F.count("order_id")
            self._parts["lines"] = F.count(F.lit(1))

    @property
    def keys(self) -> list[str]:
        """The columns that identify a summary."""
        return [*self.dims, *self.grains, *([NOT_ORDER] if len(self.grains) == 2 else [])]

    def summaries(self, df: DataFrame) -> DataFrame:
        """One row per order and one per customer within the dims (per dims if neither is needed)."""
        df = df.withColumns(self._derived) if self._derived else df
        aggregates = [c.alias(n) for n, c in self._parts.items()]
        if not self.grains:
            return df.groupBy(*self.dims).agg(*aggregates)
        keyed = df.withColumns({"__order": F.col("order_id"), "__customer": F.col("customer_id")})
        if len(self.grains) == 2:
            sets = [[*self.dims, g] for g in self.grains]
            return keyed.groupingSets(sets, *self.dims, *self.grains).agg(
                F.grouping("__order").alias(NOT_ORDER), *aggregates
            )
        return keyed.groupBy(*self.dims, *self.grains).agg(*(aggregates or [F.lit(1).alias("__one")]))

    def merged(self, summaries: DataFrame, within: Sequence[str] = ()) -> DataFrame:
        """Summaries with one row per key again; ``within`` are columns that the keys decide."""
        if not self._parts:
            return summaries.distinct()
        kept = summaries.groupBy(*within, *self.keys).agg(
            *(_MERGED.get(n, F.sum)(n).alias(n) for n in self._parts)
        )
        # sums keep the types they had
        return kept.select(*within, *self.keys, *(
            F.col(n).cast(summaries.schema[n].dataType).alias(n) for n in self._parts
        ))

    def totals(self, summaries: DataFrame, within: Sequence[str] = ()) -> DataFrame:
        """Totals by the dims, from summaries with one row per key."""
        both = len(self.grains) == 2
        is_order = F.col(NOT_ORDER) == 0 if both else F.lit(True)
        is_customer = F.col(NOT_ORDER) == 1 if both else F.lit(True)
        # row totals are taken from one grain only
        row_grain = is_order if self.by_order else is_customer
        summed = {
            n: F.sum(F.when(row_grain, F.col(n))).alias(n) for n in self._parts if n not in _OF_A_KEY
        }
        if self.by_order:
            summed["orders"] = F.count_if(is_order).alias("orders")
            for status in ("shipped", "cancelled"):
                if status in self._parts:
                    summed[status] = F.count_if(is_order & (F.col(status) == 1)).alias(status)
        if self.by_customer:
            summed["customers"] = F.count_if(is_customer).alias("customers")
        if "lowest" in self._parts:
            several = (F.col("lowest") != F.col("highest")) | (
                (F.col("with_order") > 0) & (F.col("with_order") < F.col("lines"))
            )
            summed["repeaters"] = F.count_if(is_customer & several).alias("repeaters")
        return summaries.groupBy(*within, *self.dims).agg(*summed.values())

    def added(self, totals: DataFrame) -> DataFrame:
        """Totals of disjoint keys added up by the dims."""
        names = [c for c in totals.columns if c not in self.dims]
        return totals.groupBy(*self.dims).agg(*(F.sum(n).alias(n) for n in names))

    def project(self, totals: DataFrame) -> DataFrame:
        return _project(totals, self.names, self.dims, {
            n: F.col(n) for n in totals.columns if n not in self.dims
        })


def measures(
    df: DataFrame,
    names: Sequence[str] | None = None,
    dims: Sequence[str] = (),
    statuses: Mapping[str, str] = STATUSES,
) -> DataFrame:
    """Sales measures by ``dims`` (one row without dims), all of them if none are named.

    Rows are first summed up per order and per customer within the dims, which tasks do before
    the shuffle, and then per dims. A distinct count is the number of such groups and a status
    count the number of orders with a row of that status, so no count(DISTINCT) is planned and a
    hot order, customer or dimension value costs one row per task. Only the grains that the
    wanted measures need are formed.
    """
    grains = Grains(names, dims, statuses)
    summaries = grains.summaries(df)
    # without grains the summaries are the totals
    return grains.project(grains.totals(summaries) if grains.grains else summaries)


def _project(
    totals: DataFrame, names: Sequence[str], dims: Sequence[str], has: Mapping[str, Column]
) -> DataFrame:
    results = _results(has)
    return totals.select(*dims, *[results[n].alias(MEASURES[n]) for n in names])


def top_products(df: DataFrame, k: int = 10, column: str = "product_name") -> DataFrame:
    """The ``k`` best selling products; ties go by name."""
    return measures(df, ["Total Sales"], [column]).orderBy(
        F.col("total_sales").desc(), column
    ).limit(k)


def promotion_measures(history: DataFrame) -> DataFrame:
    """Promotion counts and the average discount over every version, in one row.

    The ids of current versions are counted as groups, null included.
    """
    by_id = history.groupBy("promotion_id").agg(
        F.max(F.col("current_flag").cast("int")).alias("active"),
        F.sum("discount_pct").alias("discounts"),
        F.count("discount_pct").alias("discounted"),
        F.count(F.lit(1)).alias("versions"),
    )
    return by_id.agg(
        F.count_if(F.col("active") == 1).alias("active_promotions"),
        divide(F.sum("discounts"), F.sum("discounted")).alias("promotion_discount_average"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("promotion_history_rows"),
    )


def history_measures(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count_if("current_flag").alias("scd2_current_rows"),
        F.count(F.lit(1)).alias("scd2_total_history_rows"),
    )


def control_measures(control: DataFrame, table_name: str | None = None) -> DataFrame:
    """Latest run, number of control rows and the latest count (of one table if named).

    Of several counts at the latest moment the largest is taken.
    """
    counted = F.struct("count_timestamp", "Table_count")
    usable = F.col("Table_count").isNotNull()
    if table_name is not None:
        usable = usable & (F.col("Table_name") == table_name)
    return control.agg(
        F.max("count_timestamp").alias("latest_etl_run"),
        F.count(F.lit(1)).alias("quality_check_rows"),
        F.max(F.when(usable, counted))["Table_count"].alias("latest_table_count"),
    )
