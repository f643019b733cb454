"""Session matters: shared folders, the listing session, generated code size."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from typing import Any

from pyspark.sql import SparkSession

# Fixed value: the JVM leaves methods with more bytecode than this uncompiled.
COMPILED_METHOD_LIMIT = 8000
METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
_V1_SOURCES = "spark.sql.sources.useV1SourceList"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Keep the conversion of wide tables in code that the JVM compiles.

    A stage that converts many columns becomes one method beyond the JVM's limit
    and then runs interpreted, several times slower.  With this setting Spark
    splits such a stage into smaller methods instead.  ``run`` holds it for the
    time of a load; it changes no result, and the session gets its own value back.
    """
    before = spark.conf.get(METHOD_LIMIT_CONF)
    if int(before) > COMPILED_METHOD_LIMIT:
        spark.conf.set(METHOD_LIMIT_CONF, str(COMPILED_METHOD_LIMIT))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT_CONF, before)


def compiled_session(spark: SparkSession) -> SparkSession:
    """Sister session whose frames hold the setting of ``compiled_methods`` whenever they run."""
    sister = _sister(spark)
    if int(sister.conf.get(METHOD_LIMIT_CONF)) > COMPILED_METHOD_LIMIT:
        sister.conf.set(METHOD_LIMIT_CONF, str(COMPILED_METHOD_LIMIT))
    return sister


def footer_session(spark: SparkSession) -> SparkSession:
    """Sister session that reads Parquet by the source whose footers answer counts."""
    sister = _sister(spark)
    kept = [s for s in sister.conf.get(_V1_SOURCES).split(",") if s.strip().lower() != "parquet"]
    sister.conf.set(_V1_SOURCES, ",".join(kept))
    sister.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return sister


def _sister(spark: SparkSession) -> SparkSession:
    sister = spark.newSession()
    sister.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return sister


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared folder (``spark.checkpoint.dir``).

    Frames read what is there as long as their session lives, so it is removed when the driver's Python ends; a driver
    that is killed leaves it.  Only a local session without that setting falls back to a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", conf.get("spark.checkpoint.dir"))
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="quayside-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    _LEFT.append((at.getFileSystem(spark._jsc.hadoopConfiguration()), at))
    return path


#: File system and path of what this driver has put into shared folders.
_LEFT: list[tuple[Any, Any]] = []


@atexit.register
def _remove_left() -> None:
    for fs, at in _LEFT:
        with suppress(Exception):  # the JVM may have gone before
            fs.delete(at, True)


def listing_session(spark: SparkSession) -> SparkSession:
    """Sister session whose scans pack many files into a task.

    A listing reads no content, so the usual one-split-per-128-MB packing would
    cost a task per file.
    """
    sister = _sister(spark)
    sister.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    return sister


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
