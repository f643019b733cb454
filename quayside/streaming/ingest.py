"""Incremental loads by Structured Streaming's file source.

The checkpoint remembers the files already taken, so a run picks up what has
arrived since the last one and ends (``availableNow``).  All operators of this
package are stateless projections and apply to the stream as they stand.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..sinks.once import Folder
from ..sources.files import name_glob, name_predicate
from ..tables import Table


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name_parts: Iterable[str] = (),
    max_files: int = 10_000,
) -> DataFrame:
    """Stream of a directory's Parquet files, ``max_files`` per micro-batch."""
    parts = list(name_parts)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if parts:
        reader = reader.option("pathGlobFilter", name_glob(parts))
    return reader.parquet(path).where(name_predicate(F.col("_metadata.file_name")))


def ingest_files(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is available to a Parquet folder, exactly once."""
    _drain(
        rows.writeStream.format("parquet").option("path", path).outputMode("append")
        .option("checkpointLocation", checkpoint)
    )


def ingest_table(rows: DataFrame, table: Table, checkpoint: str, **write: Any) -> None:
    """Append what is available to a table; exactly once to one of Parquet or ORC files, at least once to others.

    A batch that failed half way is written again from its start, under the token of its first attempt: the
    checkpoint's own id and the batch's number.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        table.write(batch, token=f"{stream}-{number}", **write)
        # batches before the last are in the checkpoint and do not come again
        table.forget(spark, f"{stream}-{number - 1}")

    _drain(rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(append))
    # micro-batches run in a session of their own
    table.refresh(rows.sparkSession)


FILE_LIST = "path string, modificationTime timestamp, length bigint, content binary"
ARRIVALS = "path string, name string, modified_at timestamp, size bigint"


def arrivals(spark: SparkSession, path: str, state: str, max_files: int = 100_000) -> DataFrame:
    """``path, name, modified_at, size`` of every file that has ever arrived in a directory.

    The checkpoint of a file source forgets a file that a selection has passed over.  This stream selects nothing: it
    appends the names of new files to a list beside its checkpoint, below ``state``, and reads no content.  What is due
    is then selected from the list, less the files the ledger holds, so one that is not due yet waits for a later run.
    """
    files = (
        spark.readStream.format("binaryFile").schema(FILE_LIST).option("maxFilesPerTrigger", max_files).load(path)
        .select(
            "path", F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("modificationTime").alias("modified_at"), F.col("length").alias("size"),
        )
    )
    ingest_files(files, f"{state}/files", f"{state}/checkpoint")
    if not Folder(spark, state).has("files"):
        return spark.createDataFrame([], ARRIVALS)
    # a batch may list a file again, for one where another file's name reads as a pattern
    return spark.read.schema(ARRIVALS).parquet(f"{state}/files").dropDuplicates(["path"])


def _drain(writer: DataStreamWriter) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()
