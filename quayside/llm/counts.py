"""Token counts of documents in flat token files without an index, by a scan for the end-of-document id.

A file is a run of little-endian ids; documents follow each other, each ended by the end id. Files are cut into blocks
without regard to documents. Each block is searched at once for end ids; then running token sums and the running last
end over the small table of blocks (one row for about a million tokens) give every block what it continues, and each
document its length, also where it begins blocks earlier.

Defined cases: documents do not cross files; ids after the last end of a file are a document that is not ended; an empty
document has no tokens; an empty file or table has no documents; equal documents are counted each for itself. A block of
ids is whole: bytes beyond the last whole id of a file raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import written
from .text import slices
from .tokens import VOCABULARY, Vocabulary, read_vocabulary, vocabulary_of

BLOCK_TOKENS = 1 << 19
#: Documents listed in one row of the manifest.
_LISTED = 4096
_STREAM = "file string, block long, ids binary, docs array<{kind}>"


def _blocks(file: str, content: bytes, size: int) -> Iterator[tuple[str, int, bytes]]:
    for k, at in enumerate(range(0, len(content), size)):
        yield file, k, content[at : at + size]


def read_token_files(spark: SparkSession, path: str, *, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, ids) of every file under path; a file is read whole by a task, so files hold at most 2 GB."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if len(content) % width:
                    raise ValueError(f"{file}: {len(content)} bytes are no whole ids")
                for row in _blocks(file, content, block_tokens * width):
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["file", "block", "ids"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(work, "file string, block long, ids binary")


def token_stream(docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat files of docs, one a partition, as blocks of ids; rows without ids list the keys in the files' order."""
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[key].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary_of(held.value)
        end = np.array([own.end], own.dtype).tobytes()
        file, size = f"part-{TaskContext.get().partitionId():06d}", block_tokens * len(end)
        pending, waiting, block, listed = [], 0, 0, 0

        def row(block: int, ids: bytes | None, keys: pa.Array | None, like: pa.DataType) -> pa.RecordBatch:
            docs = pa.array([keys.to_pylist() if keys is not None else None], pa.list_(like))
            return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block]), pa.array([ids], pa.binary()), docs], names=["file", "block", "ids", "docs"])

        for batch in slices(batches, text):
            keys = batch.column(key)
            for at in range(0, len(keys), _LISTED):
                part = keys.slice(at, _LISTED)
                yield row(listed, None, part, keys.type)
                listed += len(part)
            for ids in map(own.encode, batch.column(text).to_pylist()):
                pending += [ids, end]
                waiting += len(ids) + len(end)
                if waiting >= size:
                    flat = b"".join(pending)
                    whole = waiting // size * size
                    for at in range(0, whole, size):
                        yield row(block, flat[at : at + size], None, keys.type)
                        block += 1
                    pending, waiting = [flat[whole:]], waiting - whole
            like = keys.type
        if waiting:
            yield row(block, b"".join(pending), None, like)

    return docs.select(key, text).mapInArrow(work, _STREAM.format(kind=kind.simpleString()))


def _scanner(end: int, dtype: str, kept: list[str]):
    """For each block: its tokens and the places of its ends; the `kept` columns come along."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for block in batch.column("ids"):
                ids = np.frombuffer(block.as_py() or b"", dtype)
                sizes.append(len(ids) if block.is_valid else None)
                ends.append(np.flatnonzero(ids == end) if block.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                names=[*kept, "tokens", "ends"],
            )

    return work


def scan(blocks: DataFrame, end: int, dtype: str = "<u2") -> DataFrame:
    """blocks, their ids replaced by tokens (their number) and ends (places of the end id)."""
    kept = [c for c in blocks.columns if c != "ids"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema if f.name != "ids")
    return blocks.mapInArrow(_scanner(end, dtype, kept), f"{fields}, tokens long, ends array<long>")


def stitch(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document, from the scanned blocks of a written table."""
    summary = scanned.select("file", "block", "tokens", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("base", F.coalesce(F.sum("tokens").over(past), F.lit(0)))
    summary = summary.withColumn("first", F.coalesce(F.sum("n").over(past), F.lit(0)))
    summary = summary.withColumn("open", F.coalesce(F.max(F.col("base") + F.col("last") + 1).over(past), F.lit(0)))
    placed = scanned.select("file", "block", "ends").join(summary.select("file", "block", "base", "first", "open"), ["file", "block"])
    begins = F.concat(F.array("open"), F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda e: e + F.col("base") + 1))
    ended = placed.where(F.size("ends") > 0).select("file", "first", "base", F.posexplode(F.arrays_zip(begins.alias("b"), F.col("ends").alias("e"))).alias("k", "x"))
    ended = ended.select("file", (F.col("first") + F.col("k")).alias("ordinal"), F.col("x.b").alias("start"), (F.col("x.e") + F.col("base") - F.col("x.b")).alias("n_tokens"), F.lit(True).alias("ended"))
    whole = summary.groupBy("file").agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("ordinal"), F.max(F.coalesce(F.col("base") + F.col("last") + 1, F.lit(0))).alias("start"))
    rest = whole.where("tokens > start").select("file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionAll(rest)


def count_file_tokens(spark: SparkSession, path: str, *, end: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of the documents of every token file under path."""
    blocks = read_token_files(spark, path, width=np.dtype(dtype).itemsize, block_tokens=block_tokens)
    return stitch(written(scan(blocks, end, dtype), "scan"))


def count_document_tokens(docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(key, file, ordinal, start, n_tokens) of every row of docs, by a scan of its flat token files."""
    own = Vocabulary(read_vocabulary(vocabulary)["ranks"])
    stream = token_stream(docs, key=key, text=text, vocabulary=vocabulary, block_tokens=block_tokens)
    scanned = written(scan(stream, own.end, own.dtype), "scan")
    counts = stitch(scanned.where("tokens is not null").drop("docs"))
    listed = scanned.where("tokens is null").select("file", "block", F.posexplode("docs").alias("k", key))
    listed = listed.select(key, "file", (F.col("block") + F.col("k")).alias("ordinal"))
    return listed.join(counts, ["file", "ordinal"]).select(key, "file", "ordinal", "start", "n_tokens")
