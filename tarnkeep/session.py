"""Session helpers: the shared scratch folder and lineage cuts through written tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


# Run-time settings the operators count on. A join whose hot key fills one partition
# is split even where that costs a further shuffle, because the next step groups by the same key.
# Hashes and keys, most of what is written, halve under zstd; snappy leaves them as they are. Shuffle
# files go when the action that made them ends, not when the driver happens to collect its garbage.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tarnkeep-")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Where that is absent, a session on a single
    machine uses a folder of its own; on a cluster, where executors would each write to their own
    disk, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/tarnkeep-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` to shared scratch (or a given new folder) and read it back.

    Used where two outputs need the same intermediate result. A written table survives the
    loss of executors and is read with column pruning, which a cached block is not.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # the schema is known: reading it back needs no footer sampling, also when no row was written
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(df: DataFrame, partition_by: list[str] | None = None) -> Iterator[DataFrame]:
    """As :func:`materialize`, for a result that nothing needs any longer once the block is left.

    Its folder is deleted then, also when the block fails.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    try:
        yield materialize(df, partition_by, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
