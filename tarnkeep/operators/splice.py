"""Version chains out of dated statements, in whatever order they arrive.

A statement says what a key's row is from a date on (``effective_start_date``, ``record_hash``), or
that the key is gone (an empty hash). A key's history follows from all its statements:
one that repeats what held before is only *seen* again, any other starts a version, and a
version ends where the next one, or the key's absence, starts. So a statement dated before versions
that are already known is put in its place, and splits or shortens them.

Statements of one date go by :data:`LOADED`, the load that brought them: the later one holds, and the
earlier one becomes a version of no length, as if a load had been run twice in a day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnkeep.operators.contracts import date_literal
from tarnkeep.operators.scd2 import CURRENT, END, HASH, START

#: Columns beside those of a version: the load that brought it, and what it is.
LOADED, STATE = "_loaded", "_state"
KEPT, CLOSED, SEEN, GONE = "current", "closed", "seen", "gone"
NO_ROW = ""  # the hash of a key that is gone


def _of_key(keys: Sequence[str], within: Sequence[str]):
    return Window.partitionBy(*within, *keys)


def with_absences(
    statements: DataFrame,
    keys: Sequence[str],
    is_new: Column,
    as_of: date | str | None,
    loaded: Column,
    within: Sequence[str] = (),
) -> DataFrame:
    """One more statement, that the key is gone from ``as_of``, for each key with no new one.

    It is made only where a version holds on that date.
    """
    of_key = _of_key(keys, within)
    later = F.lead(START).over(of_key.orderBy(START, LOADED))
    day = date_literal(as_of)
    holds = (
        (F.col(START) <= day) & (F.col("__later").isNull() | (F.col("__later") > day))
        & (F.col(HASH) != NO_ROW) & ~F.col("__met")
    )
    absent = F.struct(*[
        day.alias(c) if c == START
        else F.lit(NO_ROW).alias(c) if c == HASH
        else loaded.alias(c) if c == LOADED
        else F.lit(None).cast("string").alias(c) if c == STATE
        else F.lit(False).alias(c) if c == CURRENT
        else F.col(c) if c in keys or c in within
        else F.lit(None).cast(statements.schema[c].dataType).alias(c)
        for c in statements.columns
    ])
    own = F.struct(*statements.columns)
    marked = statements.withColumns({"__met": F.max(is_new).over(of_key), "__later": later})
    return marked.select(F.inline(F.when(holds, F.array(own, absent)).otherwise(F.array(own))))


def splice(statements: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Statements with the end, flag and state that follow from all statements of their key.

    ``within`` are columns the keys decide, by which the rows may be dealt already: the
    window then needs no shuffle.
    """
    chain = _of_key(keys, within).orderBy(START, LOADED)
    before = F.lag(HASH).over(chain)
    rest = chain.rowsBetween(1, Window.unboundedFollowing)
    # a key is not gone before its first version
    starts = F.when(before.isNull(), F.col(HASH) != NO_ROW).otherwise(before != F.col(HASH))
    marked = statements.withColumn("__starts", starts)
    following = F.first(F.when(F.col("__starts"), F.col(START)), ignorenulls=True).over(rest)
    state = (
        F.when(F.col(HASH) == NO_ROW, GONE).when(~F.col("__starts"), SEEN)
        .when(F.col("__next").isNull(), KEPT).otherwise(CLOSED)
    )
    visible = F.col(STATE).isin(KEPT, CLOSED)
    return (
        marked.withColumn("__next", following)
        .withColumn(STATE, state)
        .withColumns({
            END: F.when(visible, F.col("__next")).cast("date"), CURRENT: F.col(STATE) == KEPT,
        })
        .filter(F.col("__starts") | (F.col(STATE) == SEEN))
        .drop("__starts", "__next")
    )


def versions(spliced: DataFrame) -> DataFrame:
    """The rows of a history: its versions, without what was only seen again or is gone."""
    return spliced.filter(F.col(STATE).isin(KEPT, CLOSED)).drop(LOADED, STATE)
