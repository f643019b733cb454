"""From raw documents to shards: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage takes the documents its predecessor kept, as a Parquet table, and all but the last return documents in
their own columns. Near-dedup and mixing hash in ways SQL engines do not share, so there is no SQL twin; tests compare
the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.decontaminate import remove_contamination
from quayside.llm.minhash import keep_one
from quayside.llm.mix import mix
from quayside.llm.quality import keep_good
from quayside.llm.shard import SHARDS, default_tree, shard_of, with_shards
from quayside.llm.store import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and their host's verdict."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each class of near-duplicates."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice, in the order of the blocks' permutations.

    A file holds rows of one shard, so that their order in the mix becomes that of the shard without another shuffle.
    """
    shard = shard_of(F.col("doc_id"), default_tree(SHARDS))
    return mix(docs, positions=False, files_by=shard, file_values=SHARDS).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, with its document; slots follow the mix."""
    return with_shards(docs, in_place=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
    ("sharding", sharding),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
