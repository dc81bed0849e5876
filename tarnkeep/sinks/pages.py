"""Pages of paged endpoints, landed in rounds with their cursors as committed progress.

A round reads up to ``round_pages`` pages of each feed, from where it stands, and lands them below
``run=<n>/``; ``manifest/<n>.json`` then commits where every feed stands. A request that fails for
good ends its feed's round: the pages before it are landed and committed like any others, and the
failure is raised once they are. So a rerun asks for no page that was landed. Only the loss of a task in
mid-round makes its pages of this round be asked for again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.sinks.manifests import Manifests
from tarnkeep.sources.rest import Fetch, http_fetch, lane_of, read_pages

PAGE = "feed STRING, page BIGINT, body STRING, is_empty BOOLEAN, lane INT, following STRING, error STRING"
ROUND_PAGES = 100


@dataclass(frozen=True)
class PageStore:
    """The landed pages of one ingest."""

    path: str

    def _manifests(self) -> Manifests:
        return Manifests(f"{self.path}/manifest")

    def _state(self, spark: SparkSession) -> tuple[int, dict[str, Any]]:
        runs = self._manifests().runs(spark)
        fresh = {"cursors": {}, "runs": [], "complete": False, "ingested": None}
        return (runs[-1], self._manifests().read(spark, runs[-1])) if runs else (0, fresh)

    def pages(self, spark: SparkSession) -> DataFrame:
        """All pages landed so far."""
        _, state = self._state(spark)
        folders = [f"{self.path}/run={run}" for run in state["runs"]]
        rows = spark.read.schema(PAGE).parquet(*folders) if folders else spark.createDataFrame([], PAGE)
        return rows.filter("error IS NULL")

    def is_complete(self, spark: SparkSession) -> bool:
        return self._state(spark)[1]["complete"]

    def ingested(self, spark: SparkSession) -> int | None:
        """The rows that were made of the pages, once they were."""
        return self._state(spark)[1]["ingested"]

    def mark_ingested(self, spark: SparkSession, rows: int) -> None:
        run, state = self._state(spark)
        self._manifests().commit(spark, run + 1, state | {"ingested": rows})

    def land(self, spark: SparkSession, options: Mapping[str, Any], fetch: Fetch = http_fetch) -> DataFrame:
        """Read on from where the last round stopped, up to the end of all feeds; all pages."""
        size = options.get("round_pages", ROUND_PAGES)
        while True:
            run, state = self._state(spark)
            if state["complete"]:
                return self.pages(spark)
            run += 1
            asked = {**options, "round_pages": size, "land_errors": "true", "cursors": json.dumps(state["cursors"])}
            place = f"{self.path}/run={run}"
            read_pages(spark, asked, fetch).write.mode("overwrite").parquet(place)
            # one row per feed: endpoints are listed in the options
            ends = spark.read.schema(PAGE).parquet(place).groupBy("feed", "lane").agg(
                F.count("page").alias("pages"), F.max("page").alias("page"), F.max("error").alias("error"),
                F.max_by("following", F.coalesce("page", F.lit(1 << 62))).alias("following"),
            ).collect()
            cursors = dict(state["cursors"])
            for end in ends:
                lane = lane_of(end.feed, end.lane)
                before = cursors.get(lane, (0, None))
                ended = end.following is None and end.error is None
                cursors[lane] = (end.page or before[0], False if ended else end.following)
            runs = [*state["runs"], run]
            complete = all(cursor is False for _, cursor in cursors.values())
            self._manifests().commit(spark, run, state | {"cursors": cursors, "runs": runs, "complete": complete})
            failed = sorted(f"{e.feed}: {e.error}" for e in ends if e.error)
            if failed:
                raise RuntimeError("; ".join(failed))
            if not complete:
                self._refuse_circles(spark)

    def _refuse_circles(self, spark: SparkSession) -> None:
        """A cursor that comes up twice leads in a circle, however long."""
        twice = self.pages(spark).filter("following IS NOT NULL").groupBy("feed", "lane", "following").count()
        circle = twice.filter("count > 1").first()
        if circle:
            raise ValueError(f"{circle.feed}: {circle.following} was read before")
