"""Sharding by a hierarchical weighted hash tree: region, rack and shard are drawn in turn by weighted hashes.

At each level every child c of a node draws -ln(u) / weight(c), with u in (0, 1) hashed from the row's key and the
child's name, and the least draw wins. A changed weight moves rows only into or out of the child it belongs to; below
a child whose weights stay, nothing moves. Growth therefore opens a region of its own for each shard beyond
`base_shards`, the number of shards that one began with: one more shard takes rows only into itself.

All expressions are built-in functions. Slots number a shard's rows in the order of their key hash: rows are counted in
(shard, hash range) buckets, the small table of counts is summed up into first slots, and rows are numbered within
their bucket, so neither a shard nor the table meets in one task. With `in_place`, rows of Parquet files that each hold one
shard keep the order of the files' part numbers and of the rows within: their slots are the places in the files, behind
the rows of the shard's earlier files, and no text moves. Where a file holds several shards, slots are dealt by hash.

Defined cases: rows with a null key share one draw; a null text has size 8 and the checksum of no bytes; equal rows get
one shard and consecutive slots in any order; an empty table gives an empty result; columns of the input that have the
name of an output give way to it.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import broadcast_if_small, written
from .text import without

SHARDS = 24
RACKS, SHARDS_A_RACK = 2, 4
#: Rows of a bucket that one window sorts, about.
BUCKET_ROWS = 500
_OUTPUTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_TEMPORARY = ("_q_key", "_q_bucket", "_q_crc", "_q_first", "_q_s", "_q_b", "_q_file", "_q_row")

#: (region, rack, shard, weight) of each leaf.
Tree = list[tuple[int, int, int, float]]


def default_tree(shards: int, base_shards: int = SHARDS) -> Tree:
    """Regions of 2 racks of 4 shards up to base_shards, then a region for each further shard."""
    region = RACKS * SHARDS_A_RACK
    base = min(shards, base_shards)
    tree = [(s // region, s // SHARDS_A_RACK, s, 1.0) for s in range(base)]
    first = -(-base // region)
    return tree + [(first + k, 1_000_000 + s, s, 1.0) for k, s in enumerate(range(base, shards))]


def _draw(key: Column, level: str, name: int, weight: float) -> Column:
    """-ln(u) / weight, u from 52 bits of a hash of key and child."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(name)), 12)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(weight)


def _descend(key: Column, leaves: Tree, level: int = 0) -> Column:
    """The shard below this node that the key draws."""
    if level == 3:
        return F.lit(leaves[0][2])
    children: dict[int, Tree] = defaultdict(list)
    for leaf in leaves:
        children[leaf[level]].append(leaf)
    parts = [(name, sum(x[3] for x in below), _descend(key, below, level + 1)) for name, below in sorted(children.items())]
    if len(parts) == 1:
        return parts[0][2]
    draws = [_draw(key, ("region", "rack", "shard")[level], name, weight) for name, weight, _ in parts]
    least = F.least(*draws)
    return reduce(lambda rest, p: F.when(p[0] == least, p[1]).otherwise(rest), list(zip(draws, (p[2] for p in parts), strict=True))[-2::-1], parts[-1][2])


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard (int) of a key."""
    leaves = [x for x in tree if x[3] > 0]
    if not leaves:
        raise ValueError("no shard has a weight")
    return _descend(key, leaves).cast("int")


def _described(key: str, text: str, tree: Tree, grown: Tree) -> list[Column]:
    return [
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.encode(F.col(text).cast("string"), "utf-8"), F.lit(b""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    ]


def _rows_of_files(docs: DataFrame) -> DataFrame | None:
    """docs with _q_file and _q_row, the place of each row in the Parquet files read; None where docs is no scan of files."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias("_q_file"), F.col("_metadata.row_index").alias("_q_row"))
    except AnalysisException:
        return None


def _firsts_of_files(rows: DataFrame, shard: Column) -> DataFrame | None:
    """(_q_file, _q_first): a shard's rows in files of lower part numbers; None where a file holds several shards or parts."""
    files = rows.groupBy("_q_file").agg(
        F.min(shard).alias("s"), F.max(shard).alias("most"), F.count("*").alias("n"), F.max("_q_row").alias("last")
    )
    files = written(files, "files")
    if not files.where("s <> most or n <> last + 1").isEmpty():
        return None
    part = F.regexp_extract("_q_file", r"part-(\d+)[^/]*$", 1).try_cast("long")
    before = Window.partitionBy("s").orderBy(part, "_q_file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("_q_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_q_first"))


def with_shards(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = SHARDS, base_shards: int | None = None,
    tree: Tree | None = None, grown: Tree | None = None, carry: list[str] | None = None, in_place: bool = False,
) -> DataFrame:
    """The columns `carry` (default: all) of docs with size, text_crc32, law, shard, slot and grown_shard."""
    base_shards = min(shards, SHARDS) if base_shards is None else base_shards
    tree = default_tree(shards, base_shards) if tree is None else tree
    grown = default_tree(shards + 1, base_shards) if grown is None else grown
    if in_place and (rows := _rows_of_files(docs)) is not None:
        firsts = _firsts_of_files(rows, shard_of(F.col(key), tree))
        if firsts is not None:
            slot = (F.col("_q_row") + F.col("_q_first")).alias("slot")
            columns = without(docs, (*_OUTPUTS, *_TEMPORARY)).columns if carry is None else carry
            return rows.join(broadcast_if_small(firsts), "_q_file").select(*columns, *_described(key, text, tree, grown), slot).select(
                *columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
            )
    base = without(docs, (*_OUTPUTS, *_TEMPORARY))
    carry = base.columns if carry is None else carry
    out = base.select(*carry, *_described(key, text, tree, grown), F.xxhash64(F.lit("slot"), F.col(key)).alias("_q_key"))
    leaves = len({x[2] for x in tree})
    buckets = max(1, -(-base.count() // (BUCKET_ROWS * leaves)))
    out = out.withColumn("_q_bucket", F.pmod(F.shiftrightunsigned("_q_key", 20), F.lit(buckets)))
    counts = (
        base.select(shard_of(F.col(key), tree).alias("_q_s"), F.xxhash64(F.lit("slot"), F.col(key)).alias("k"))
        .groupBy("_q_s", F.pmod(F.shiftrightunsigned("k", 20), F.lit(buckets)).alias("_q_b"))
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("_q_s").orderBy("_q_b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = broadcast_if_small(counts.select("_q_s", "_q_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_q_first")))
    within = Window.partitionBy("shard", "_q_bucket").orderBy("_q_key", key, "text_crc32", "size")
    numbered = out.withColumn("slot", F.row_number().over(within) - 1)
    joined = numbered.join(firsts, (F.col("shard") == F.col("_q_s")) & (F.col("_q_bucket") == F.col("_q_b")))
    return joined.select(*carry, "size", "text_crc32", "law", "shard", (F.col("slot") + F.col("_q_first")).alias("slot"), "grown_shard")
