"""Slowly changing history, type 2: one row per version of a key.

A version is valid in ``[effective_start_date, effective_end_date)``; the end of the current
version is null. A key that is missing from the input stays current.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.operators.contracts import date_literal
from tarnkeep.operators.dedup import first_per_key

START, END, CURRENT, HASH = (
    "effective_start_date", "effective_end_date", "current_flag", "record_hash",
)


def record_hash(columns: Sequence[str], null_token: str | None = None) -> Column:
    """MD5 over the text of the columns, joined by ``||``.

    Nulls are skipped unless ``null_token`` stands in for them; without it a value that moves
    from one column to its null neighbour goes unnoticed. With it bars and backslashes in values
    are escaped too, so that a separator within a value can't stand for one between values.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        escaped = [F.replace(p, F.lit("\\"), F.lit("\\\\")) for p in parts]
        escaped = [F.replace(p, F.lit("|"), F.lit("\\|")) for p in escaped]
        parts = [F.coalesce(p, F.lit(null_token)) for p in escaped]
    return F.md5(F.concat_ws("||", *parts))


def scd2_stage(
    df: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str | None = None,
    null_token: str | None = None,
    order_by: Sequence[str | Column] | None = None,
    dated_by: str | None = None,
) -> DataFrame:
    """Incoming rows as current versions: one per key, with validity columns and hash.

    With ``dated_by``, a date column, rows hold from that date (``as_of`` where it is null) and there is one
    per key and date. Rows with a null in the key are left out, see :func:`scd2_rejects`.
    """
    columns = [*keys, *tracked]
    keyed = df.dropna(how="any", subset=list(keys))
    start, one_per = date_literal(as_of), list(keys)
    if dated_by is not None:
        keyed = keyed.withColumn(START, F.coalesce(F.col(dated_by).cast("date"), start))
        start, one_per = F.col(START), [*keys, START]
    if order_by is None:
        keyed = keyed.select(*columns, *one_per[len(keys):])
    return first_per_key(keyed, one_per, order_by).select(
        *columns,
        start.alias(START),
        F.lit(None).cast("date").alias(END),
        F.lit(True).alias(CURRENT),
        record_hash(columns, null_token).alias(HASH),
    )


def scd2_met(
    df: DataFrame, keys: Sequence[str], as_of: date | str | None = None, dated_by: str | None = None
) -> DataFrame:
    """The keys and start dates of the rows that :func:`scd2_stage` chooses from, all of them."""
    start = date_literal(as_of)
    if dated_by is not None:
        start = F.coalesce(F.col(dated_by).cast("date"), start)
    return df.dropna(how="any", subset=list(keys)).select(*keys, start.alias(START))


def scd2_rejects(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key has a null: no version could ever be matched to them."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(missing)


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(CURRENT)


def scd2_changes(current: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows that are new, or differ from the current version of their key.

    Only the key and the hash of the current rows take part, so a columnar scan stays narrow.
    """
    known = current.select(*keys, F.col(HASH).alias("__hash"), F.lit(True).alias("__known"))
    return (
        staged.join(known, list(keys), "left")
        .filter(F.col("__known").isNull() | (F.col("__hash") != F.col(HASH)))
        .select(*staged.columns)
    )


def scd2_advance(
    current: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    as_of: date | str | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """Current versions joined once with the staged ones: kept, closed and new versions.

    Both sides hold each key once, so the full outer join has no hot key. Every joined row gives
    one or two versions.
    """
    columns = current.columns
    old = current.select(*keys, F.struct(*columns).alias("__old"))
    new = staged.select(*keys, F.struct(*columns).alias("__new"))

    # a load dated before the version it closes would end that version before it began
    early = F.raise_error(F.concat(
        F.lit("load dated before the current version's start: "), F.col("__old")[START].cast("string")
    )).cast("date")
    end = F.when(F.col("__old")[START] > date_literal(as_of), early).otherwise(date_literal(as_of))
    closed = F.struct(*[
        end.alias(END) if c == END
        else F.lit(False).alias(CURRENT) if c == CURRENT
        else F.col("__old")[c].alias(c)
        for c in columns
    ])
    changed = F.col("__old")[HASH] != F.col("__new")[HASH]
    versions = (
        F.when(F.col("__old").isNull(), F.array("__new"))
        .when(F.col("__new").isNull(), F.array(closed) if close_missing else F.array("__old"))
        .when(changed, F.array(closed, F.col("__new")))
        .otherwise(F.array("__old"))
    )
    return old.join(new, list(keys), "full_outer").select(F.inline(versions))


def scd2_apply(
    history: DataFrame | None,
    staged: DataFrame,
    keys: Sequence[str],
    as_of: date | str | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """The history after loading ``staged``. Versions closed earlier bypass the join."""
    if history is None:
        return staged
    advanced = scd2_advance(current_rows(history), staged, keys, as_of, close_missing)
    return history.filter(f"NOT {CURRENT}").unionByName(advanced)


def scd2_counts(history: DataFrame) -> DataFrame:
    """One row: current versions and all versions."""
    return history.agg(
        F.count_if(CURRENT).alias("current_rows"), F.count(F.lit(1)).alias("total_rows")
    )
