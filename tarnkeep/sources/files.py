"""Scans: CSV text, tables by path and tables by name."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.operators.contracts import Contract, apply_contract


#: Header lines read at a time.
_READERS = 16


def header_groups(
    spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None = None
) -> list[list[str]]:
    """The files of a CSV set by their header line; files without one are left out.

    Only the first lines are read, by the driver's file system client, several files at a time.
    """
    comment = {k.lower(): v for k, v in (options or {}).items()}.get("comment")
    jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(configuration)

    def header(file: str) -> str | None:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = place.getFileSystem(configuration).open(place)
        try:
            codec = codecs.getCodec(place)
            plain = stream if codec is None else codec.createInputStream(stream)
            # one character per byte: lines are only compared
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "ISO-8859-1"))
            line = lines.readLine()
            while line is not None and (not line.strip() or comment and line.startswith(comment)):
                line = lines.readLine()
            return line
        finally:
            stream.close()

    found = sorted(spark.read.text(path).inputFiles())
    groups = defaultdict(list)
    with ThreadPoolExecutor(_READERS) as pool:
        for file, line in zip(found, pool.map(header, found), strict=True):
            if line is not None:
                groups[line].append(file)
    return list(groups.values())


def read_csv_by_name(
    spark: SparkSession,
    path: str | list[str],
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
    file_as: str | None = None,
) -> DataFrame:
    """As :func:`read_csv_text`, for files whose headers differ in order or lack columns.

    Files are grouped by their header line, each group is read by its own header, and
    the groups are united by name. Each file is scanned once; a column that a file
    lacks is null for its rows. ``file_as`` names a column for the path of a row's file.
    """
    def read(files: str | list[str]) -> DataFrame:
        rows = read_csv_text(spark, files, options, malformed)
        return rows if file_as is None else rows.select("*", F.col("_metadata.file_path").alias(file_as))

    groups = header_groups(spark, path, options)
    if len(groups) < 2:
        return read(path)
    parts = [read(group) for group in groups]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [malformed] if malformed is not None else []
    return whole.select(*[c for c in whole.columns if c not in last], *last)


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """A CSV file set with a header line, every column as text.

    Only the header of one file is looked at beforehand; types are never inferred, which would
    cost a second pass over all files. Every file's own header is checked against that first one
    while it is read, so files with another column order fail instead of shifting their values.

    A line with more or fewer fields than the header fails the read too. With ``malformed``, the
    name of a further column, it is kept instead and that column holds the whole line (null for
    all others); Spark wants another column read along with it. The option ``mode`` overrides this.
    """
    reader = spark.read.options(header=True, **dict(options or {}))
    names = reader.csv(path).columns
    if malformed in names:
        raise ValueError(f"the files have a column {malformed} of their own")
    # fields are counted only if all columns are parsed
    reader = reader.option("enforceSchema", False).option("columnPruning", False)
    if malformed is not None:
        names = [*names, malformed]
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    elif "mode" not in {o.lower() for o in options or {}}:
        reader = reader.option("mode", "FAILFAST")
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader.schema(as_text).csv(path)


def csv_rejects(
    spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None = None
) -> DataFrame:
    """Lines with more or fewer fields than the header: their fields, and ``line`` as a whole."""
    text = read_csv_text(spark, path, options, "line")
    return text.filter(F.col("line").isNotNull())


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
    by_name: bool = False,
) -> DataFrame:
    """A CSV file set cast to its contract; a value that cannot be cast is null.

    ``malformed`` as in :func:`read_csv_text`; the column comes last. With ``by_name`` the files may
    differ in the order of their columns, and lack some (:func:`read_csv_by_name`).
    """
    read = read_csv_by_name if by_name else read_csv_text
    text = read(spark, path, options, malformed)
    kept = [c for c in text.columns if c in contract.columns or c == malformed]
    others = [c for c in text.columns if c not in kept]
    return apply_contract(text.drop(*others), contract, keep_others=malformed is not None)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, jvm_path = _file_system(spark, path)
    return file_system.exists(jvm_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    file_system, jvm_path = _file_system(spark, path)
    if not file_system.exists(jvm_path):
        return []
    return [s.getPath().getName() for s in file_system.listStatus(jvm_path) if s.isDirectory()]


def child_files(spark: SparkSession, path: str, folders: bool = False) -> list[str]:
    """Names of the files (or folders) with rows directly below ``path``; none if it does not exist."""
    file_system, jvm_path = _file_system(spark, path)
    if not file_system.exists(jvm_path):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in file_system.listStatus(jvm_path)]
    return [name for name, folder in found if folder == folders and name[0] not in "._"]


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a catalog table of that name, or a folder at that path, is there."""
    if "/" in target:
        return path_exists(spark, target)
    return spark.catalog.tableExists(target)
