"""Helpers the operators of this subpackage share: tables, columns from texts, order, scratch."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.session import materialize

__all__ = [
    "table", "doc_columns", "materialize", "per_text", "part_count", "bounds_of", "in_range",
    "range_of", "id_text", "crc_of_id",
]

#: Bytes of a batch that goes to Python at once; long texts then make short batches.
BATCH_BYTES = "8m"


@lru_cache(maxsize=8)
def _ship(application: str, context) -> None:
    """Send this package's modules to the executors' Python, where it isn't installed."""
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tarnkeep-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))


def prepare(spark: SparkSession) -> SparkSession:
    """Ship our code, and keep batches to Python small in bytes, whatever the length of texts."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # shuffle files go when the action that made them ends, not when the driver happens to collect its garbage
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def doc_columns(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, so that further columns can't clash with ours."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def crc_of_id(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def as_bytes(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 of each text, the empty string for null."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def per_text(make: Callable[[], Callable], schema: str, *columns: Column | str) -> Column:
    """A struct column computed from texts in Arrow batches.

    ``make`` is called once per task and returns a function from the batch's columns (pandas
    series) to a pandas frame of ``schema``; what it loads is thus loaded once per task.
    """
    if len(columns) == 1:
        @F.pandas_udf(schema)
        def one(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            f = make()
            for x in batches:
                yield f(x)

        return one(*columns)

    @F.pandas_udf(schema)
    def several(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        f = make()
        for x in batches:
            yield f(*x)

    return several(*columns)


def part_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bounds_of(docs: DataFrame, parts: int) -> np.ndarray:
    """Ascending ids that cut the non-null doc_ids into about ``parts`` even ranges."""
    if parts < 2:
        return np.zeros(0, dtype=np.int64)
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.approxQuantile("doc_id", shares, 0.25 / parts)
    return np.unique(np.array(cuts, dtype=np.int64))


def id_text() -> Column:
    """doc_id as text (null: empty), which keeps all digits on the way to Python."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def range_of(bounds: np.ndarray, ids: Iterable[str]) -> np.ndarray:
    """The range each id (as text) falls in; nulls fall in the first."""
    known = np.array([int(x) if x else 0 for x in ids], dtype=np.int64)
    at = np.searchsorted(bounds, known, side="right")
    return np.where([x == "" for x in ids], 0, at).astype(np.int32)


def in_range(bounds: np.ndarray) -> Column:
    """The range a doc_id falls in."""
    @F.pandas_udf("int")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield pd.Series(range_of(bounds, ids))

    return find(id_text())
