"""Tables that cut lineage, written below the cluster's shared folder, and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows of a table that may be broadcast. Such tables hold one short row a source, host or template.
BROADCAST_ROWS = 100_000


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: an executor lost later costs no recomputation of it."""
    path = shared_dir(df.sparkSession, f"llm-{purpose}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the shared folder; of small tables that only live for a query."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast where the counted rows allow it; beyond that Spark's joins shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
