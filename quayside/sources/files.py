"""Parquet sources: scans, file listings and file selection.

Selection by name and time is a predicate on the hidden ``_metadata`` column,
which Spark evaluates while it plans the scan: files that do not qualify are
never opened.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import footer_session

# File selection modes.
ALL, BY_MTIME, ALL_PENDING, BY_NAME_TIME = 0, 1, 2, 3
SUCCESS_MARK = "_SUCCESS"


def escape_glob(text: str) -> str:
    return "".join("\\" + ch if ch in r"\*?[]{}" else ch for ch in text)


def name_glob(parts: Iterable[str]) -> str | None:
    """Glob for file names that contain any of ``parts``; None without parts."""
    escaped = [f"*{escape_glob(p)}*" for p in parts]
    return "{" + ",".join(escaped) + "}" if escaped else None


def name_predicate(name: Column, parts: Iterable[str] = ()) -> Column:
    """File name holds any of ``parts`` (all names without parts) and no success mark."""
    wanted = [F.contains(name, F.lit(p)) for p in parts]
    keep = ~F.contains(name, F.lit(SUCCESS_MARK))
    return keep & reduce(Column.__or__, wanted) if wanted else keep


def mode_predicate(
    mode: int, run_at: datetime | None, name: Column, modified_at: Column
) -> Column | None:
    """Condition of a selection mode, or None where the mode takes every file."""
    if mode <= ALL or mode == ALL_PENDING or run_at is None:
        return None
    if mode == BY_NAME_TIME:
        clock = int(f"{run_at:%H%M%S}")
        times = F.filter(F.split(name, "_"), lambda p: p.rlike(r"^[0-9]{6}\z"))
        return F.exists(times, lambda p: p.try_cast("int") <= clock)
    return modified_at < F.to_timestamp(F.lit(f"{run_at:%Y-%m-%d %H:%M:%S.%f}"))


def scan_parquet(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    name_parts: Iterable[str] = (),
    mode: int = ALL,
    run_at: datetime | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Rows of the selected Parquet files of a directory.

    Without ``schema`` the first file's schema counts, or that of all files
    with ``merge_schema``; columns a file lacks are NULL.
    """
    parts = list(name_parts)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    if parts:
        reader = reader.option("pathGlobFilter", name_glob(parts))
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    name, modified_at = F.col("_metadata.file_name"), F.col("_metadata.file_modification_time")
    df = df.where(name_predicate(name))
    condition = mode_predicate(mode, run_at, name, modified_at)
    return df if condition is None else df.where(condition)


def list_files(
    spark: SparkSession, path: str, name_parts: Iterable[str] = (), extension: str = "", recursive: bool = False
) -> DataFrame:
    """``path, name, modified_at, size`` of a directory's files; no content is read.

    ``extension`` is the end of the names, in the case given; ``recursive`` lists the folders below as well.  Empty files
    are not listed.
    """
    parts = list(name_parts)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if parts:
        reader = reader.option("pathGlobFilter", name_glob(parts))
    elif extension:
        reader = reader.option("pathGlobFilter", f"*{escape_glob(extension)}")
    files = reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("size"),
    )
    files = files.where(name_predicate(F.col("name")))
    return files.where(F.endswith("name", F.lit(extension))) if extension else files


def select_files(files: DataFrame, mode: int, run_at: datetime | None = None) -> DataFrame:
    """Listed files that a selection mode takes."""
    condition = mode_predicate(mode, run_at, F.col("name"), F.col("modified_at"))
    return files if condition is None else files.where(condition)


def source_stats(df: DataFrame) -> DataFrame:
    """``file_path, row_count`` of a file scan; reads no column."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("row_count")
    )


def footer_counts(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """``path, row_count`` of Parquet sources, each a file or a folder: Spark answers the counts from their footers.

    A source is a part of the plan, so this is for a list of sources; ``source_stats`` counts the files of one.
    """
    sister = footer_session(spark)
    counts = [
        sister.read.parquet(p).agg(F.count("*").alias("row_count")).select(F.lit(p).alias("path"), "row_count")
        for p in paths
    ]
    return reduce(DataFrame.unionAll, counts)
