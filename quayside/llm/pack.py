"""Packing token ids into fixed rows: best-fit-decreasing with a segment tree over free capacities.

Every document becomes its ids and an end id. Documents over the row length are split losslessly into full rows and a
rest. Segments are packed in blocks of about `block_tokens` tokens, as the documents come in a task: longest first, each
into the row with the least free space that holds it, found in a segment tree by free space. A packed row holds the ids
(padded with the end id), the cumulative segment lengths, and position ids that restart at 0 with each segment.

Nothing is shuffled and no task holds more than a block. A task that runs again packs the same rows if its input comes
in the same order, as that of a table scan does.

Defined cases: a null or empty text is a segment of its end id alone, so every row of the input is packed; equal rows
are packed each for itself; of equally long segments the earlier comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .text import slices
from .tokens import VOCABULARY, read_vocabulary, vocabulary_of

ROW_TOKENS = 2048
BLOCK_TOKENS = 1 << 22


class Capacities:
    """How many open rows have each amount of free space, as a segment tree of counts."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1 - 1).bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, free: int, n: int) -> None:
        node = self.size + free
        while node:
            self.counts[node] += n
            node >>= 1

    def least(self, needed: int) -> int:
        """The least free space of needed or more that a row has; -1 if none."""
        node = self.size + needed
        if self.counts[node]:
            return needed
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return -1


def best_fit(lengths: np.ndarray, row_tokens: int) -> list[list[int]]:
    """Segment numbers of each row."""
    tree = Capacities(row_tokens)
    by_free: dict[int, list[int]] = {}
    rows: list[list[int]] = []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        free = tree.least(n)
        if free < 0:
            row, free = len(rows), row_tokens
            rows.append([])
        else:
            row = by_free[free].pop()
            tree.add(free, -1)
        rows[row].append(k)
        if free > n:
            by_free.setdefault(free - n, []).append(row)
            tree.add(free - n, 1)
    return rows


def _packer(held, key: str, text: str, row_tokens: int, block_tokens: int):
    def packed(ids: list[bytes], owners: pa.Array, first_row: int) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(held.value)
        width = np.dtype(vocabulary.dtype).itemsize
        data, segments = np.frombuffer(b"".join(ids), vocabulary.dtype), []
        at = 0
        for doc, own in enumerate(ids):
            n = len(own) // width
            segments += [(doc, k, min(row_tokens, n - k), at + k) for k in range(0, n, row_tokens)]
            at += n
        doc, offset, length, start = (np.array(x, np.int64) for x in zip(*segments, strict=True))
        rows = best_fit(length, row_tokens)
        for low in range(0, len(rows), 256):
            out = {name: [] for name in ("n_tokens", "cu_seqlens", "offsets", "ids", "positions")}
            own = []
            for row in rows[low : low + 256]:
                ends = np.cumsum(length[row])
                matrix = np.full(row_tokens, vocabulary.end, vocabulary.dtype)
                places = np.zeros(row_tokens, "<u4" if row_tokens > 1 << 16 else "<u2")
                for k, end in zip(row, ends.tolist(), strict=True):
                    n = int(length[k])
                    matrix[end - n : end] = data[start[k] : start[k] + n]
                    places[end - n : end] = np.arange(n)
                out["n_tokens"].append(int(ends[-1]))
                out["cu_seqlens"].append([0, *ends.tolist()])
                out["offsets"].append(offset[row].tolist())
                out["ids"].append(matrix.tobytes())
                out["positions"].append(places.tobytes())
                own.append(doc[row])
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(own)) + first_row + low),
                    pa.array(out["n_tokens"], pa.int64()),
                    pa.array([len(x) for x in own], pa.int64()),
                    pa.ListArray.from_arrays(sizes, owners.take(pa.array(np.concatenate(own)))),
                    pa.array(out["offsets"], pa.list_(pa.int64())),
                    pa.array(out["cu_seqlens"], pa.list_(pa.int32())),
                    pa.array(out["ids"], pa.binary()),
                    pa.array(out["positions"], pa.binary()),
                ],
                names=["row_id", "n_tokens", "n_segments", "doc_ids", "offsets", "cu_seqlens", "ids", "positions"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(held.value)
        end = np.array([vocabulary.end], vocabulary.dtype).tobytes()
        row = TaskContext.get().partitionId() << 33
        ids: list[bytes] = []
        owners: list[pa.Array] = []
        size = 0
        for batch in slices(batches, text):
            for own in map(vocabulary.encode, batch.column(text).to_pylist()):
                ids.append(own + end)
                size += len(ids[-1]) // len(end)
            owners.append(batch.column(key))
            if size >= block_tokens:
                for out in packed(ids, pa.concat_arrays(owners), row):
                    yield out
                    row += out.num_rows
                ids, owners, size = [], [], 0
        if ids:
            yield from packed(ids, pa.concat_arrays(owners), row)

    return work


def pack(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
    row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Packed rows: row_id, n_tokens, n_segments, doc_ids and token offsets of the segments, cu_seqlens, ids, positions.

    ids and positions are the row of each matrix as little-endian integers of two bytes (four beyond 65,536 values).
    """
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"row_id long, n_tokens long, n_segments long, doc_ids array<{kind}>, offsets array<long>, cu_seqlens array<int>, ids binary, positions binary"
    return docs.select(key, text).mapInArrow(_packer(held, key, text, row_tokens, block_tokens), schema)
