"""Row rules, the good/bad split and simple flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.names import quoted


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate that is true for a row breaking the rule."""

    name: str
    broken_when: str

    @property
    def broken(self) -> Column:
        return F.coalesce(F.expr(self.broken_when), F.lit(False))


@dataclass(frozen=True)
class Required(Rule):
    """The column must not be null. Kept apart so that the null test reaches the scan."""

    @property
    def broken(self) -> Column:
        return F.expr(self.broken_when)


def required(*columns: str) -> list[Rule]:
    return [Required(f"{c}_missing", f"{quoted(c)} IS NULL") for c in columns]


# The order columns that must be filled.
REQUIRED_ORDER_COLUMNS = (
    "order_id", "customer_id", "order_date", "product_name", "quantity", "unit_price",
    "total_amount",
)


def order_rules(expected_total: str = "quantity * unit_price") -> list[Rule]:
    """The order rules; ``expected_total`` is the SQL expression the total must equal."""
    return [
        *required(*REQUIRED_ORDER_COLUMNS),
        Rule("quantity_not_positive", "quantity <= 0"),
        Rule("unit_price_negative", "unit_price < 0"),
        Rule("total_negative", "total_amount < 0"),
        Rule("total_inconsistent", f"total_amount <> {expected_total}"),
    ]


def any_broken(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [r.broken for r in rules], F.lit(False))


def annotate(df: DataFrame, rules: Sequence[Rule], out: str = "violations") -> DataFrame:
    """Add the array of broken rule names, empty for a good row."""
    names = F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules])
    return df.withColumn(out, F.array_compact(names))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows; every input row lands in exactly one of them."""
    broken = any_broken(rules)
    return df.filter(~broken), df.filter(broken)


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking each rule, in one pass: one aggregate row turned into one row per rule."""
    counts = df.agg(*[F.count_if(r.broken).alias(r.name) for r in rules])
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rows")) for r in rules]
    return counts.select(F.inline(F.array(*pairs)))


def flag_regex(df: DataFrame, column: str, pattern: str, out: str = "matches_regex") -> DataFrame:
    """Add whether the text matches. Meant for raw text: a parsed date always looks right."""
    return df.withColumn(out, F.col(column).cast("string").rlike(pattern))
