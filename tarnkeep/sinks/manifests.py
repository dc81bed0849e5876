"""Numbered JSON documents in a folder; the appearance of a number's document commits a load."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from tarnkeep.sources.files import _file_system, child_files


@dataclass(frozen=True)
class Manifests:
    """Documents ``<n>.json`` in the folder ``path``."""

    path: str

    def runs(self, spark: SparkSession) -> list[int]:
        names = (n.removesuffix(".json") for n in child_files(spark, self.path))
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, spark: SparkSession, run: int) -> dict[str, Any]:
        file_system, place = _file_system(spark, f"{self.path}/{run}.json")
        stream = file_system.open(place)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, spark: SparkSession, run: int, document: dict[str, Any]) -> None:
        """Write the document of ``run``; raises if there is one already."""
        target = f"{self.path}/{run}.json"
        file_system, draft = _file_system(spark, f"{target}.draft")
        stream = file_system.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(document).encode()))
        finally:
            stream.close()
        # renamed, so that a document is there as a whole or not at all
        place = spark._jvm.org.apache.hadoop.fs.Path(target)
        if file_system.exists(place) or not file_system.rename(draft, place):
            raise RuntimeError(f"run {run} in {self.path} was committed by another load")

    def delete(self, spark: SparkSession, run: int) -> None:
        file_system, place = _file_system(spark, f"{self.path}/{run}.json")
        file_system.delete(place, False)
