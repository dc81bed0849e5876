"""Measures kept up to date: appended facts change them without the facts before being read.

Below ``path`` the summaries per order and customer (:class:`tarnkeep.plans.measures.Grains`) lie in buckets of
their key, and the totals of each bucket beside them::

    summaries/run=<n>/bucket=<b>/   the summaries of a bucket after load n
    totals/run=<n>/                 what these come to, by bucket and dims
    manifest/<n>.json               per bucket the run that holds it, and the loads taken

A load is summed up by key, merged with the summaries of the buckets it touches, and these buckets are
written anew: one exchange for the rows, one by bucket. Keys of different buckets are disjoint, so the measures are the totals of all
buckets added up; a report reads these few rows only. A load's name commits with it: the same
load again, as after a failure, changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.plans.measures import STATUSES, Grains
from tarnkeep.sinks.manifests import Manifests

BUCKET = "bucket"


@dataclass(frozen=True)
class MeasureStore:
    """Measures by ``dims`` below ``path``; ``buckets`` stays as they grow."""

    path: str
    names: Sequence[str]
    dims: Sequence[str] = ()
    statuses: Mapping[str, str] = field(default_factory=lambda: dict(STATUSES))
    buckets: int = 64

    def __post_init__(self) -> None:
        if BUCKET in self.dims:
            raise ValueError(f"a dimension can't be named {BUCKET}")

    def _grains(self) -> Grains:
        return Grains(self.names, self.dims, self.statuses)

    def _told(self) -> list:
        return [list(self.names), list(self.dims), sorted(self.statuses.items()), self.buckets]

    def _manifests(self) -> Manifests:
        return Manifests(f"{self.path}/manifest")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        runs = self._manifests().runs(spark)
        if not runs:
            return 0, {"buckets": {}, "loads": [], "schemas": {}}
        state = self._manifests().read(spark, runs[-1])
        if state["of"] != _plain(self._told()):
            raise ValueError(f"{self.path} keeps other measures: {state['of']}")
        return runs[-1], state

    def _summaries(self, spark: SparkSession, state: dict, buckets: Sequence[int]) -> DataFrame | None:
        paths = [
            f"{self.path}/summaries/run={state['buckets'][str(b)]}/{BUCKET}={b}"
            for b in buckets if str(b) in state["buckets"]
        ]
        if not paths:
            return None
        schema = T.StructType.fromJson(state["schemas"]["summaries"]).add(BUCKET, T.IntegerType())
        found = spark.read.schema(schema).option("basePath", f"{self.path}/summaries").parquet(*paths)
        return found.drop("run")

    def append(self, facts: DataFrame, load: str) -> bool:
        """Take the rows of a load, named uniquely; False if it was taken before."""
        spark, grains = facts.sparkSession, self._grains()
        run, state = self._state(spark)
        if load in state["loads"]:
            return False
        run += 1
        key = F.xxhash64(*(grains.keys or [F.lit(0)]))
        fresh = grains.summaries(facts).withColumn(BUCKET, F.pmod(key, F.lit(self.buckets)).cast("int"))
        place = f"{self.path}/summaries/run={run}"
        # what the load touches is known once it is summed up; that is written first
        staged = f"{self.path}/loads/run={run}"
        fresh.write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
        plain = T.StructType([f for f in fresh.schema if f.name != BUCKET])
        new = spark.read.schema(fresh.schema).parquet(staged)
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
        old = self._summaries(spark, state, touched)
        both = new if old is None else old.unionByName(new)
        dealt = both.repartition(self.buckets, BUCKET)
        grains.merged(dealt, [BUCKET]).write.mode("overwrite").partitionBy(BUCKET).parquet(place)
        written = spark.read.schema(fresh.schema).parquet(place)
        totals = grains.totals(written, [BUCKET])
        totals.write.mode("overwrite").parquet(f"{self.path}/totals/run={run}")
        self._manifests().commit(spark, run, {
            "of": _plain(self._told()), "loads": [*state["loads"], load],
            "buckets": state["buckets"] | {str(b): run for b in touched},
            "schemas": {"summaries": plain.jsonValue(), "totals": totals.schema.jsonValue()},
        })
        return True

    def measures(self, spark: SparkSession) -> DataFrame:
        """The measures over all loads taken."""
        grains, (run, state) = self._grains(), self._state(spark)
        if not run:
            raise ValueError(f"{self.path} has taken no load")
        schema = T.StructType.fromJson(state["schemas"]["totals"])
        runs = sorted(set(state["buckets"].values()))
        if not runs:
            return grains.project(grains.added(spark.createDataFrame([], schema).drop(BUCKET)))
        rows = spark.read.schema(schema.add("run", T.IntegerType())).option("basePath", f"{self.path}/totals").parquet(
            *(f"{self.path}/totals/run={r}" for r in runs)
        )
        live = spark.createDataFrame(
            [(int(b), r) for b, r in state["buckets"].items()], f"{BUCKET} int, run int"
        )
        # one row per bucket: as small as the manifest
        return grains.project(grains.added(rows.join(F.broadcast(live), [BUCKET, "run"]).drop(BUCKET, "run")))


def _plain(value):
    """As JSON gives it back."""
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value
