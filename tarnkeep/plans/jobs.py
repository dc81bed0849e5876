"""The composed jobs: orders to clean and silver tables, histories, API ingest and checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.contracts import Contract, drop_incomplete, rename, with_audit
from tarnkeep.operators.counts import (
    CONTROL, latest_entries, log_row_count, table_counts,
)
from tarnkeep.operators.dedup import distinct_mostly, distinct_rows, first_per_key
from tarnkeep.operators.profiling import ddl, profile_of_states, profile_states, profile_tables
from tarnkeep.operators.quality import CheckStates, run_config
from tarnkeep.operators.records import items_to_table
from tarnkeep.operators.rules import Rule, annotate, order_rules
from tarnkeep.operators.scd2 import (
    record_hash, scd2_advance, scd2_changes, scd2_met, scd2_rejects, scd2_stage,
)
from tarnkeep.operators.states import PART_OF
from tarnkeep.plans.tables import ORDER_DEDUP_KEYS, ORDERS, HistorySpec
from tarnkeep.session import materialize, temporary
from tarnkeep.sinks.buckets import KeyBuckets
from tarnkeep.sinks.history import HistoryStore
from tarnkeep.sinks.pages import PageStore
from tarnkeep.sinks.states import PartStates
from tarnkeep.sinks.tables import ensure_table, write_path, write_report, write_table
from tarnkeep.sources.files import (
    read_csv, read_csv_by_name, read_csv_text, read_path, read_table,
)
from tarnkeep.sources.rest import Fetch, http_fetch, page_items, read_pages

# How the order keys are named from the clean table on.
CLEAN_NAMES = {"order_id": "orderid", "customer_id": "customerid"}
LOAD_TIME = "Load_Datetime"

MALFORMED = "malformed_line"

# stands in for a null in the row hash, so that a value moving between columns is noticed
NULL_TOKEN = "\x00"


def clean_orders(
    bronze: DataFrame,
    complete: Sequence[str] | None = None,
    as_of: datetime | str | None = None,
    distinct: Callable[[DataFrame], DataFrame] = distinct_rows,
) -> DataFrame:
    """Bronze to clean: keys renamed, exact copies and incomplete rows dropped, load time added.

    Incomplete rows are dropped before the shuffle of the deduplication rather than after it,
    which gives the same rows.
    """
    renamed = rename(bronze, CLEAN_NAMES)
    return with_audit(distinct(drop_incomplete(renamed, complete)), LOAD_TIME, as_of)


@dataclass(frozen=True)
class MedallionTables:
    bronze: str
    clean: str
    silver: str
    control: str
    appended: str | None = None


def medallion_job(
    spark: SparkSession,
    source: str,
    tables: MedallionTables,
    contract: Contract = ORDERS,
    complete: Sequence[str] | None = None,
    as_of: datetime | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV to bronze, clean and silver tables; logs the silver row count and returns the entry.

    Each layer reads the table before it, so the text is parsed once and the deduplication runs
    once. ``appended`` names a table that gains the clean rows of every run.
    """
    write_table(read_csv(spark, source, contract, options), tables.bronze)
    bronze = read_table(spark, tables.bronze)
    write_table(clean_orders(bronze, complete, as_of, distinct_mostly), tables.clean)
    clean = read_table(spark, tables.clean)
    write_table(clean.drop(LOAD_TIME), tables.silver)
    ensure_table(spark, tables.control, CONTROL)
    entry = log_row_count(spark, tables.silver, tables.control, as_of)
    if tables.appended:
        write_table(clean, tables.appended, "append")
    return entry


@dataclass(frozen=True)
class CleansingCounts:
    source: int
    clean: int
    bad: int


def cleanse_orders_job(
    spark: SparkSession,
    source: str,
    clean_path: str,
    bad_path: str,
    contract: Contract = ORDERS,
    rules: Sequence[Rule] | None = None,
    keys: Sequence[str] = ORDER_DEDUP_KEYS,
    as_of: datetime | str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> CleansingCounts:
    """CSV to a clean and a bad table; counts are read back from what was written.

    The text is read and judged once, into a written table split by the verdict, and each output
    opens only its half; that table is deleted at the end. Lines with more or fewer fields than
    the header are bad rows of their own rule, and kept whole in ``malformed_line``.
    """
    rows = read_csv(spark, source, contract, options, MALFORMED)
    rules = order_rules() if rules is None else rules
    judged = annotate(rows, [Rule(MALFORMED, f"{MALFORMED} IS NOT NULL"), *rules])
    judged = judged.withColumn(
        "verdict", F.when(F.size("violations") == 0, "good").otherwise("bad")
    )
    with temporary(judged, partition_by=["verdict"]) as judged:
        good = judged.filter("verdict = 'good'").select(*contract.names)
        bad = judged.filter("verdict = 'bad'").select(*contract.names, MALFORMED, "violations")
        write_path(
            with_audit(first_per_key(good, keys), "ingestion_timestamp", as_of), clean_path, fmt=fmt
        )
        write_path(with_audit(bad, "bad_record_timestamp", as_of), bad_path, fmt=fmt)
        return CleansingCounts(
            judged.count(),
            read_path(spark, clean_path, fmt).count(),
            read_path(spark, bad_path, fmt).count(),
        )


def load_history(
    spark: SparkSession,
    rows: DataFrame,
    store: HistoryStore | KeyBuckets,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str | None = None,
    null_token: str | None = NULL_TOKEN,
    close_missing: bool = False,
    rejects_path: str | None = None,
    dated_by: str | None = None,
    confirm: bool = False,
) -> int:
    """Load typed rows into a history; returns the number of its latest run.

    :class:`KeyBuckets` takes rows of any dates (``dated_by``, ``confirm``) and rewrites the buckets that change.
    For the other stores the staged rows are written first: the comparison and the load both need them.
    The comparison reads keys and hashes only. No run is written if nothing differs.
    """
    if rejects_path is not None:
        write_path(scd2_rejects(rows, keys), rejects_path, "append")
    if isinstance(store, KeyBuckets):
        staged = scd2_stage(rows, keys, tracked, as_of, null_token, dated_by=dated_by)
        return store.load(
            staged, as_of, close_missing, confirm, met=scd2_met(rows, keys, as_of, dated_by),
            hashed=record_hash([*keys, *tracked], null_token), dealt=dated_by is None,
        )
    if dated_by is not None or confirm:
        raise ValueError("only a history in key buckets takes rows of several dates")
    staged = scd2_stage(rows, keys, tracked, as_of, null_token)
    run = store.last_run(spark)
    if run == 0:
        store.write_run(staged, 1)
        return 1
    staged = store.stage(staged)
    current = store.current(spark, run)
    unchanged = scd2_changes(current, staged, keys).isEmpty()
    if unchanged and close_missing:
        unchanged = current.join(staged, list(keys), "left_anti").isEmpty()
    if unchanged:
        return run
    store.write_run(scd2_advance(current, staged, keys, as_of, close_missing), run + 1)
    return run + 1


def history_job(
    spark: SparkSession,
    source: str,
    store: HistoryStore | KeyBuckets,
    spec: HistorySpec,
    as_of: date | str | None = None,
    csv_options: Mapping[str, str] | None = None,
    **options: Any,
) -> int:
    """CSV file set into a history."""
    rows = read_csv(spark, source, spec.contract, csv_options)
    return load_history(spark, rows, store, spec.keys, spec.tracked, as_of, **options)


def rest_ingest_job(
    spark: SparkSession,
    options: Mapping[str, Any],
    target: str,
    schema: str | None = None,
    fetch: Fetch = http_fetch,
    fmt: str = "parquet",
    store: PageStore | None = None,
) -> int:
    """Fetch all pages, turn their records into a table and append it; returns its row count.

    The bodies are landed first, so every page is asked for once, whatever happens afterwards;
    then their records are, so that bodies are parsed once. With a ``store`` they stay landed: a run after a
    failure goes on with the first page that is not there, and one after success appends nothing.
    """
    def appended(landed: DataFrame) -> int:
        with temporary(page_items(landed, options).select("item")) as items:
            count = items.count()
            if count:
                write_path(items_to_table(items, schema), target, "append", fmt)
            return count

    if store is None:
        with temporary(read_pages(spark, options, fetch)) as landed:
            return appended(landed)
    known = store.ingested(spark)
    if known is None:
        known = appended(store.land(spark, options, fetch))
        store.mark_ingested(spark, known)
    return known


def quality_job(
    spark: SparkSession,
    config: Mapping[str, Any],
    target: str,
    run_date: date | str | None = None,
    fmt: str = "json",
) -> DataFrame:
    """Check every table of a configuration, append the report and return it."""
    report = materialize(run_config(spark, config))
    write_report(report, target, run_date, fmt)
    return report


def quality_states_job(
    spark: SparkSession,
    source: str,
    checks: Sequence[Mapping[str, Any]],
    store: PartStates,
    table_name: str | None = None,
    fmt: str = "parquet",
    by: str = "folder",
) -> DataFrame:
    """The report on a folder of files; only parts that changed since the last report are read."""
    sample = read_path(spark, source, fmt)
    of_checks = CheckStates(sample, checks)
    rows = store.refresh(spark, source, of_checks.of, of_checks.signature, by, fmt)
    return of_checks.report(rows, table_name)


def profile_states_job(
    spark: SparkSession,
    source: str,
    store: PartStates,
    ladder: str = "a",
    table_name: str = "table",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The profile of a CSV file set; only files that are new or changed are read.

    Files may differ in the order of their columns, and lack some.
    """
    def read(paths: list[str]) -> DataFrame:
        return read_csv_by_name(spark, paths, options, file_as=PART_OF)

    def compute(df: DataFrame) -> DataFrame:
        return profile_states(df, ladder)

    rows = store.refresh(spark, source, compute, f"profile {ladder}", "file", read=read)
    return profile_of_states(rows, table_name)


def definitions_job(
    spark: SparkSession,
    sources: Mapping[str, str | list[str]],
    schema: str,
    ladder: str = "a",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV file sets by table name into the statements that create their tables.

    All values of all files are profiled, in one aggregation.
    """
    tables = {name: read_csv_text(spark, path, options) for name, path in sources.items()}
    return ddl(profile_tables(tables, ladder), schema)


def validation_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Row counts after a run."""
    return table_counts(spark, tables)


def latest_control_rows(spark: SparkSession, control: str, k: int = 20) -> DataFrame:
    """The newest rows of the control table."""
    return latest_entries(spark.table(control), k)
