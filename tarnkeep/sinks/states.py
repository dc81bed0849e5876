"""States of a table's parts, kept beside it: a refresh reads only the parts that changed.

A part is a folder of files, or a file. Its fingerprint covers the names, sizes and times of its files,
which Spark lists without reading them. Layout below ``path``: ``run=<n>/`` holds the state rows that refresh n
computed, ``manifest/<n>.json`` the parts with their fingerprints and runs; the manifest's
appearance commits the refresh. Parts that are gone drop out of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.states import PART_OF, STATE
from tarnkeep.sinks.manifests import Manifests

#: Runs in use from which on a refresh gathers all states into its own.
GATHER_AT = 32
_FILE = "_metadata.file_path"
_FOLDER = "^(.*)/[^/]*$"


def _part(file, by: str):
    return file if by == "file" else F.regexp_extract(file, _FOLDER, 1)


def file_parts(spark: SparkSession, source: str, by: str = "folder") -> dict[str, tuple[str, list[str]]]:
    """Parts below ``source`` with their fingerprints and the paths of their files."""
    if by not in ("folder", "file"):
        raise ValueError(f"parts are by folder or file, not {by}")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    files = listed.select(
        F.col(_FILE).alias("file"), "path", "length", F.unix_micros("modificationTime").alias("at")
    )
    rows = files.groupBy(_part(F.col("file"), by).alias("part")).agg(
        F.md5(F.to_json(F.array_sort(F.collect_list(F.struct("file", "length", "at"))))).alias("fingerprint"),
        F.collect_list("path").alias("paths"),
    ).collect()
    return {r.part: (r.fingerprint, sorted(r.paths)) for r in rows}


def read_parts(spark: SparkSession, paths: list[str], source: str, by: str, fmt: str, **options) -> DataFrame:
    """The rows of files with their part in ``__part``."""
    rows = spark.read.format(fmt).options(basePath=source, **options).load(paths)
    return rows.select("*", _part(F.col(_FILE), by).alias(PART_OF))


@dataclass(frozen=True)
class PartStates:
    """The states of one table, for one set of metrics."""

    path: str

    def _manifests(self) -> Manifests:
        return Manifests(f"{self.path}/manifest")

    def states(self, spark: SparkSession) -> DataFrame:
        """The state rows of all parts known."""
        runs = self._manifests().runs(spark)
        if not runs:
            return spark.createDataFrame([], STATE)
        return self._rows(spark, self._manifests().read(spark, runs[-1])["parts"])

    def _rows(self, spark: SparkSession, parts: dict[str, list]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], STATE)
        live = spark.createDataFrame([(p, run) for p, (_, run) in parts.items()], "part string, run int")
        # only runs in use are opened; the list of parts is as short as that of the table's folders
        folders = [f"{self.path}/run={run}" for run in sorted({run for _, run in parts.values()})]
        used = spark.read.schema(f"{STATE}, run int").option("basePath", self.path).parquet(*folders)
        return used.join(live, ["part", "run"]).select("part", "kind", "metric", "bucket", "value", "data")

    def refresh(
        self,
        spark: SparkSession,
        source: str,
        compute: Callable[[DataFrame], DataFrame],
        signature: str,
        by: str = "folder",
        fmt: str = "parquet",
        read: Callable[[list[str]], DataFrame] | None = None,
        **options,
    ) -> DataFrame:
        """Compute the states of parts that are new or changed, and return those of all parts.

        ``compute`` maps rows with ``__part`` to state rows; ``signature`` names what it computes: another one computes all
        parts anew. ``read`` maps paths to such rows, if the format alone doesn't.
        """
        manifests = self._manifests()
        runs = manifests.runs(spark)
        last = manifests.read(spark, runs[-1]) if runs else {"signature": signature, "parts": {}}
        known = last["parts"] if last["signature"] == signature else {}
        found = file_parts(spark, source, by)
        changed = [p for p, (mark, _) in found.items() if p not in known or known[p][0] != mark]
        kept = {p: v for p, v in known.items() if p in found and p not in changed}
        if not changed and len(kept) == len(last["parts"]):
            return self._rows(spark, kept)
        run = runs[-1] + 1 if runs else 1
        gathered = len({r for _, r in kept.values()}) >= GATHER_AT
        made = []
        if changed:
            paths = [path for p in sorted(changed) for path in found[p][1]]
            rows = read(paths) if read else read_parts(spark, paths, source, by, fmt, **options)
            made.append(compute(rows))
        if gathered:
            made.append(self._rows(spark, kept))
            kept = {p: [mark, run] for p, (mark, _) in kept.items()}
        for i, rows in enumerate(made):
            rows.write.mode("overwrite" if i == 0 else "append").parquet(f"{self.path}/run={run}")
        parts = kept | {p: [found[p][0], run] for p in changed}
        manifests.commit(spark, run, {"signature": signature, "parts": parts, "computed": sorted(changed)})
        return self._rows(spark, parts)

    def computed(self, spark: SparkSession) -> list[str]:
        """The parts that the latest refresh read."""
        runs = self._manifests().runs(spark)
        return self._manifests().read(spark, runs[-1])["computed"] if runs else []
