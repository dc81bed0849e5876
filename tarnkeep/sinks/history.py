"""History tables kept as runs of a load.

Every load adds one run, holding the current versions after the load and the versions closed by
it. The history after run n is the current part of run n with the closed parts of all runs up to
n, so versions closed long ago are never read, joined or written again. One write job commits a
run; what a failed load leaves behind does not count and is overwritten by the next load.

Runs are folders of plain columnar files, or catalog tables bucketed by the key. With buckets the
comparison and the load join bucket by bucket and the history is never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.scd2 import HASH
from tarnkeep.session import materialize
from tarnkeep.sources.files import child_folders, path_exists


def _with_state(versions: DataFrame) -> DataFrame:
    state = F.when(F.col("current_flag"), F.lit("current")).otherwise(F.lit("closed"))
    return versions.withColumn("state", state)


class HistoryStore(Protocol):
    """Where the runs of one history are kept."""

    def last_run(self, spark: SparkSession) -> int:
        """The number of the latest committed run; 0 before the first load."""

    def stage(self, staged: DataFrame) -> DataFrame:
        """Write the staged rows of a load and read them back."""

    def write_run(self, versions: DataFrame, run: int) -> None:
        """Write the current versions and the newly closed ones as run ``run``."""

    def current(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        """The current versions after ``run`` (the latest if not given)."""

    def history(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        """All versions as they were after ``run`` (the latest if not given)."""


@dataclass(frozen=True)
class HistoryFolder:
    """Runs as folders ``run=<n>`` below ``path``; a run counts once its success marker is there."""

    path: str

    def last_run(self, spark: SparkSession) -> int:
        runs = sorted(
            (int(name.removeprefix("run=")) for name in child_folders(spark, self.path)
             if name.startswith("run=")),
            reverse=True,
        )
        return next((n for n in runs if path_exists(spark, f"{self.path}/run={n}/_SUCCESS")), 0)

    def stage(self, staged: DataFrame) -> DataFrame:
        return materialize(staged)

    def write_run(self, versions: DataFrame, run: int) -> None:
        writer = _with_state(versions).write.mode("overwrite").partitionBy("state")
        writer.parquet(f"{self.path}/run={run}")

    def current(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        run = self.last_run(spark) if run is None else run
        return (
            spark.read.option("basePath", self.path).parquet(f"{self.path}/run={run}")
            .filter("state = 'current'").drop("run", "state")
        )

    def history(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        run = self.last_run(spark) if run is None else run
        live = (F.col("state") == "current") & (F.col("run") == run)
        closed = (F.col("state") == "closed") & (F.col("run") <= run)
        return spark.read.parquet(self.path).filter(live | closed).drop("run", "state")


@dataclass(frozen=True)
class HistoryTable:
    """Runs as tables ``<name>_run_<n>`` bucketed by the key.

    The catalog lists a table once its write has succeeded, which commits the run. ``buckets``
    should give buckets of about the size of a shuffle partition; it stays as the history grows.
    """

    name: str
    keys: Sequence[str]
    buckets: int

    def _by_bucket(self, df: DataFrame) -> DataFrame:
        """One bucket per task, so that each bucket becomes one file; hashes are shuffled as bytes."""
        if HASH not in df.columns:
            return df.repartition(self.buckets, *self.keys)
        is_hex = F.lower(F.hex(F.unhex(HASH))).eqNullSafe(F.col(HASH))
        packed = df.withColumns({
            "__bytes": F.when(is_hex, F.unhex(HASH)), HASH: F.when(~is_hex, F.col(HASH)),
        })
        dealt = packed.repartition(self.buckets, *self.keys)
        return dealt.withColumn(HASH, F.coalesce(HASH, F.lower(F.hex("__bytes")))).drop("__bytes")

    def _save(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)

    def last_run(self, spark: SparkSession) -> int:
        schema, _, prefix = self.name.rpartition(".")
        within = f"IN {schema} " if schema else ""
        tables = spark.sql(f"SHOW TABLES {within}LIKE '{prefix}_run_*'").collect()
        runs = (re.fullmatch(re.escape(prefix) + r"_run_(\d+)", t.tableName, re.I) for t in tables)
        return max((int(m[1]) for m in runs if m), default=0)

    def stage(self, staged: DataFrame) -> DataFrame:
        table = f"{self.name}_staged"
        self._save(self._by_bucket(staged), table)
        return staged.sparkSession.table(table)

    def write_run(self, versions: DataFrame, run: int) -> None:
        # later runs come from a join of bucketed tables, which leaves one bucket in each task
        aligned = self._by_bucket(versions) if run == 1 else versions
        self._save(_with_state(aligned), f"{self.name}_run_{run}", ["state"])

    def _part(self, spark: SparkSession, run: int, state: str) -> DataFrame:
        return spark.table(f"{self.name}_run_{run}").filter(F.col("state") == state).drop("state")

    def current(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        run = self.last_run(spark) if run is None else run
        return self._part(spark, run, "current")

    def history(self, spark: SparkSession, run: int | None = None) -> DataFrame:
        run = self.last_run(spark) if run is None else run
        closed = [self._part(spark, n, "closed") for n in range(2, run + 1)]
        return reduce(DataFrame.unionByName, closed, self.current(spark, run))
