"""Column profiles of text tables and the table definitions that follow from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.names import named
from tarnkeep.functions.text import clean_identifier
from tarnkeep.operators.states import MAX, PART_OF, SUM, merged

# The date and time spellings that count as a date, each with the shape of its
# text. ISO spellings are cast, the others parsed by their format; text of no such shape costs
# the pattern tests and no more.
ISO_SHAPE = r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?)?"
DATE_SHAPES = (
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?", "M/d/yyyy H:mm[:ss]"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"),
    (r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
    (r"\d{1,2}-[A-Z][a-z]{2}-\d{4}", "d-MMM-yyyy"),
    (r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "MMM d, yyyy"),
)
# The shortest and the longest of those spellings.
SHORTEST_DATE, LONGEST_DATE = 8, 32


@dataclass(frozen=True)
class Ladder:
    """What counts as a whole number, a number and a boolean word; tried in this order."""

    integer_type: str
    number: str
    boolean_words: tuple[str, ...]


# The two type ladders. B knows 32-bit whole numbers and grouped digits only.
LADDERS = {
    "a": Ladder(
        "bigint",
        r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:[+-]?(nan|inf|infinity))",
        ("true", "false", "0", "1"),
    ),
    "b": Ladder(
        "int",
        r"[+-]?(\d[\d,]*\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:[+-]?(nan|infinity))",
        ("true", "false", "0", "1", "yes", "no"),
    ),
}

# The longest bounded text type, and the Spark type of each profiled type.
LONGEST_TEXT = 4000
SPARK_TYPES = {
    "BIGINT": "BIGINT",
    "FLOAT": "DOUBLE",
    "DATETIME2": "TIMESTAMP",
    "BIT": "BOOLEAN",
}


def is_date_text(text: Column) -> Column:
    parsed = [
        F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(fmt)))
        for shape, fmt in DATE_SHAPES
    ]
    plausible = F.length(text).between(SHORTEST_DATE, LONGEST_DATE) & text.rlike("[0-9]{4}")
    found = F.when(text.rlike(f"^{ISO_SHAPE}$"), text.try_cast("timestamp")).when(
        plausible, F.coalesce(*parsed)
    )
    return found.isNotNull()


def _values(df: DataFrame, table_name: str) -> DataFrame:
    """The table as (table, position, column, text) rows."""
    pairs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            named(name).cast("string").alias("value"),
        )
        for i, name in enumerate(df.columns)
    ]
    return df.select(F.lit(table_name).alias("table_name"), F.inline(F.array(*pairs)))


#: What a ladder counts of a column; all are sums, but for the length.
COUNTERS = ("rows", "filled", "whole", "numeric", "dates", "booleans", "max_length")


def _counted(values: DataFrame, steps: Ladder, by: Sequence[str]) -> DataFrame:
    longest_word = max(map(len, steps.boolean_words))
    value, digits, numeric = F.col("value"), F.col("digits"), F.col("numeric")
    tested = (
        values.withColumn("value", F.when(value != "", value))
        .withColumn("number", F.trim("value"))
        .withColumn("digits", F.col("number").rlike(r"^[+-]?\d+$"))
        .withColumn("numeric", digits | F.col("number").rlike(f"^({steps.number})$"))
    )
    # a failing cast is far dearer than a pattern test, so only digits are cast
    whole = F.when(digits, F.col("number").try_cast(steps.integer_type)).isNotNull()
    boolean = (F.length(value) <= longest_word) & F.lower(value).isin(*steps.boolean_words)
    return tested.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("filled"),
        F.count_if(whole).alias("whole"),
        F.count_if(numeric).alias("numeric"),
        F.count_if(F.when(~numeric, is_date_text(value))).alias("dates"),
        F.count_if(boolean).alias("booleans"),
        F.max(F.length(value)).alias("max_length"),
    )


def _typed(counted: DataFrame) -> DataFrame:
    def all_are(count: str) -> Column:
        return F.col(count) == F.col("filled")

    sql_type = (
        F.when(F.col("filled") == 0, F.lit(f"NVARCHAR({LONGEST_TEXT})"))
        .when(all_are("whole"), F.lit("BIGINT"))
        .when(all_are("numeric"), F.lit("FLOAT"))
        .when(all_are("dates"), F.lit("DATETIME2"))
        .when(all_are("booleans"), F.lit("BIT"))
        .when(
            F.col("max_length") <= LONGEST_TEXT,
            F.format_string("NVARCHAR(%d)", F.col("max_length")),
        )
        .otherwise(F.lit("NVARCHAR(MAX)"))
    )
    return counted.select(
        "table_name", "position", "column", sql_type.alias("sql_type"),
        "rows", "filled", "max_length",
    )


def _profiled(values: DataFrame, steps: Ladder) -> DataFrame:
    return _typed(_counted(values, steps, ["table_name", "position", "column"]))


def profile_states(df: DataFrame, ladder: str = "a") -> DataFrame:
    """The ladder's counters of each part of ``df``, named in ``__part``, as state rows."""
    columns = [c for c in df.columns if c != PART_OF]
    pairs = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), named(c).cast("string").alias("value"))
        for i, c in enumerate(columns)
    ]
    values = df.select(F.col(PART_OF).alias("part"), F.inline(F.array(*pairs)))
    counted = _counted(values, LADDERS[ladder], ["part", "position", "column"])
    rows = [
        F.struct(
            F.lit(MAX if c in ("max_length", "position") else SUM).alias("kind"),
            F.concat(F.lit(f"{c}|"), "column").alias("metric"), F.lit(None).cast("bigint").alias("bucket"),
            F.col(c).cast("bigint").alias("value"), F.lit(None).cast("binary").alias("data"),
        )
        for c in (*COUNTERS, "position")
    ]
    return counted.select("part", F.inline(F.array(*rows)))


def profile_of_states(rows: DataFrame, table_name: str = "table") -> DataFrame:
    """The profile out of :func:`profile_states` of any parts, as :func:`profile` gives it over all rows.

    A column that some parts lack is judged by the others.
    """
    named_values = merged(rows).select(
        F.substring_index("metric", "|", 1).alias("counter"),
        F.expr("substring(metric, instr(metric, '|') + 1)").alias("column"), "value",
    )
    whole = ("position", "max_length")
    counted = named_values.groupBy("column").agg(*(
        F.max(F.when(F.col("counter") == c, F.col("value"))).cast("int" if c in whole else "bigint").alias(c)
        for c in (*COUNTERS, "position")
    ))
    return _typed(counted.withColumn("table_name", F.lit(table_name)))


def profile(df: DataFrame, ladder: str = "a", table_name: str = "table") -> DataFrame:
    """The narrowest type holding all values of each column: one row per column.

    The table is turned into (position, value) pairs and aggregated once. Tasks pre-aggregate to
    one row per column, so the shuffle stays as small as the column list whatever the table size.
    Whole tables are profiled.
    """
    return _profiled(_values(df, table_name), LADDERS[ladder])


def profile_tables(tables: dict[str, DataFrame], ladder: str = "a") -> DataFrame:
    """Profiles of several tables, in one aggregation."""
    values = reduce(DataFrame.unionAll, [_values(df, name) for name, df in tables.items()])
    return _profiled(values, LADDERS[ladder])


def ddl(profiles: DataFrame, schema: str) -> DataFrame:
    """Spark statements creating the schema and each profiled table: one row per table."""
    spark_type = F.coalesce(
        *[F.when(F.col("sql_type") == have, F.lit(want)) for have, want in SPARK_TYPES.items()],
        F.lit("STRING"),
    )
    quoted = F.concat(F.lit("`"), F.replace(F.col("column"), F.lit("`"), F.lit("``")), F.lit("`"))
    columns = F.array_sort(
        F.collect_list(F.struct("position", F.concat_ws(" ", quoted, spark_type).alias("text")))
    )
    return profiles.groupBy("table_name").agg(columns.alias("columns")).select(
        "table_name",
        F.lit(f"CREATE SCHEMA IF NOT EXISTS `{schema}`").alias("schema_ddl"),
        F.concat(
            F.lit(f"CREATE TABLE `{schema}`.`"),
            clean_identifier(F.col("table_name")),
            F.lit("` (\n  "),
            F.array_join(F.col("columns.text"), ",\n  "),
            F.lit("\n)"),
        ).alias("table_ddl"),
    )
