"""Vector codes: integer product quantisation with exact sums, over tries of distinct parts.

Each component x becomes floor(256 x); a vector is cut into equal consecutive parts, and every part position has its own
codebook. It starts as that part of the vectors with the smallest keys; a round assigns every part to the nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry by the floored mean of its parts; unused
entries stay. A last pass assigns all parts again.

A pass reads blocks of vectors within a task. The distinct parts of a block and position, sorted, are the leaves of a
trie over their components. It is walked depth first, so many nodes of a level at a time: a node's distances to all entries
so far are its parent's plus one component's, shared by all parts below. Leaves take the argmin, and each leaf counts as
often as it occurs. Only a sum and a count for each entry leave a task; the driver holds the codebooks, whose size the
parameters fix. Nothing is shuffled but these sums and, at the end, sums of the error by label.

Arithmetic is exact: blocks whose numbers might pass 64 bits are computed in Python's integers, and sums move as text.

Defined cases: a vector that is null or holds a null or non-finite component is left out; the dimension is that of the
vector with the smallest key, and vectors of another length stay, with null code and error; so does the error of a vector
whose sum passes 64 bits. Of equal keys the lesser vector counts first, null keys come last. With fewer vectors than
entries the codebooks are shorter; an empty table gives an empty result. A dimension that does not divide into the parts
raises ValueError. Carried columns that have the name of an output give way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import broadcast_if_small, written
from .text import without

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors whose parts share tries, and nodes of a level that are expanded at a time.
BLOCK, NODES = 8192, 2048
_LONG = 1 << 63
_SAFE = 1 << 62
_OUTPUTS = ("code", "error", "label_error", "codebooks_sha256")

#: Integer entries by part and index, each a list of components.
Codebooks = list[list[list[int]]]


class Trie(NamedTuple):
    """Distinct rows of a sorted matrix by prefix: the nodes of level j are the distinct prefixes of j + 1 components."""

    values: list[np.ndarray]
    parents: list[np.ndarray]
    children: list[np.ndarray]
    weights: np.ndarray
    leaf_of_row: np.ndarray


def build_trie(parts: np.ndarray) -> Trie:
    """Trie over the rows of a matrix; a leaf weighs as many rows as are equal to it."""
    n, depth = parts.shape
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.zeros(n, bool)
    new[:1] = True
    values, parents, children, before = [], [], [], np.zeros(1, np.int64)
    for j in range(depth):
        new[1:] |= ordered[1:, j] != ordered[:-1, j]
        starts = np.flatnonzero(new)
        values.append(ordered[starts, j])
        parent = np.searchsorted(before, starts, "right") - 1
        parents.append(parent)
        children.append(np.searchsorted(parent, np.arange(len(before) + 1)))
        before = starts
    leaf_of_row = np.empty(n, np.int64)
    leaf_of_row[order] = np.cumsum(new) - 1
    return Trie(values, parents, children, np.diff(np.append(before, n)), leaf_of_row)


def nearest(trie: Trie, entries: np.ndarray, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each leaf, and its squared distance."""
    depth, n = len(trie.values), len(trie.weights)
    index, distance = np.empty(n, np.int64), np.empty(n, entries.dtype)

    def walk(level: int, low: int, high: int, so_far: np.ndarray) -> None:
        """Nodes low to high of a level hold `so_far`; walk down below them, `nodes` children at a time."""
        if level == depth:
            index[low:high] = so_far.argmin(axis=1)
            distance[low:high] = so_far[np.arange(high - low), index[low:high]]
            return
        first, last = trie.children[level][low], trie.children[level][high]
        for at in range(first, last, nodes):
            to = min(at + nodes, last)
            step = trie.values[level][at:to, None] - entries[None, :, level]
            walk(level + 1, at, to, so_far[trie.parents[level][at:to] - low] + step * step)

    if n:
        walk(0, 0, 1, np.zeros((1, len(entries)), entries.dtype))
    return index, distance


def kept_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors count, their lengths, and all finite components of those, one after the other."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    inner = vectors.flatten()
    x = inner.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # nulls come as NaN
    owner = np.repeat(np.arange(len(vectors)), lengths)
    keep = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    keep[owner[~np.isfinite(x)]] = False
    return keep, lengths, x[keep[owner]]


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where they do not fit; scale is a power of two."""
    if not len(x) or np.abs(x).max() * scale < 2.0**62:
        return np.floor(x * scale).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 2.0**52 else int(np.floor(v * scale)) for v in x.tolist()], object)


def blocks(
    batches: Iterator[pa.RecordBatch], vector: str, dim: int, scale: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of the vectors that count, which of them have `dim` components, and the integers of those."""
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            piece = batch.slice(low, BLOCK)
            keep, lengths, x = kept_rows(piece.column(vector))
            fits = lengths[keep] == dim
            x = x[np.repeat(fits, lengths[keep])]
            yield piece.filter(pa.array(keep)), fits, scaled(x, scale).reshape(-1, dim)


def assign(matrix: np.ndarray, books: Codebooks) -> Iterator[tuple[Trie, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: the trie of its distinct values, the entry and distance of each leaf, and the matrix of the part."""
    width = matrix.shape[1] // len(books)
    low = max((abs(c) for book in books for e in book for c in e), default=0)
    high = int(np.abs(matrix).max()) if matrix.size else 0
    # a vector's whole error stays below 2^62, or Python's integers do it
    small = matrix.dtype != object and (low + high) ** 2 * max(1, matrix.shape[1]) < _SAFE
    kind = np.int64 if small else object
    for p, book in enumerate(books):
        part = matrix[:, p * width : (p + 1) * width].astype(kind, copy=False)
        trie = build_trie(part)
        yield trie, *nearest(trie, np.array(book, kind).reshape(len(book), width)), part


def _sums(vector: str, books: Codebooks, dim: int, scale: int):
    """Task: by part and entry, the number of its vectors' parts and the sums of their components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dim // len(books)
        counts = np.zeros((len(books), len(books[0])), np.int64)
        sums = np.zeros((len(books), len(books[0]), width), object)
        for _, _, matrix in blocks(batches, vector, dim, scale):
            for p, (trie, entry, _, part) in enumerate(assign(matrix, books)):
                np.add.at(counts[p], entry, trie.weights)
                each = entry[trie.leaf_of_row]
                if part.dtype == object or len(part) * int(np.abs(part).max(initial=0)) >= _SAFE:
                    here = np.zeros(sums[p].shape, object)
                else:
                    here = np.zeros(sums[p].shape, np.int64)
                np.add.at(here, each, part)
                sums[p] += here.astype(object)
        yield _sum_rows({(p, e): [int(counts[p, e]), *sums[p, e]] for p, e in zip(*map(np.ndarray.tolist, np.nonzero(counts)))})

    return work


def _sum_rows(sums: dict[tuple[int, int], list[int]]) -> pa.RecordBatch:
    """Sums by (part, entry) as rows; numbers go as text, which holds any integer."""
    rows = [{"part": p, "entry": e, "sums": list(map(str, v))} for (p, e), v in sums.items()]
    return pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.string()))]))


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the sums of all tasks, added up for each (part, entry) of its own; holds one row of each."""
    total: dict[tuple[int, int], list[int]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            at, given = (r["part"], r["entry"]), map(int, r["sums"])
            total[at] = [a + b for a, b in zip(total[at], given)] if at in total else list(given)
    yield _sum_rows(total)


def first_codebooks(vectors: DataFrame, vector: str, key: str, parts: int, entries: int, scale: int) -> tuple[Codebooks, int]:
    """The parts of the vectors with the smallest keys, and the dimension."""
    good = vectors.where(f"forall(`{vector}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    ordered = good.select(F.col(vector).alias("v"), F.col(key).alias("k")).orderBy(F.asc_nulls_last("k"), "v")
    head = ordered.select("v").first()
    if head is None:
        return [], 0
    dim = len(head.v)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components do not divide into {parts} parts")
    rows = ordered.where(F.size("v") == dim).limit(entries).collect()
    first = [scaled(np.array(r.v, np.float64), scale).tolist() for r in rows]
    width = dim // parts
    return [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)], dim


def fit_codebooks(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks:
    """Codebooks after the rounds, over all vectors."""
    books, dim = first_codebooks(vectors, vector, key, parts, entries, scale)
    if not books:
        return books
    schema = "part int, entry int, sums array<string>"
    column = vectors.select(F.col(vector).alias("v"))
    for _ in range(rounds):
        partial = column.mapInArrow(_sums("v", books, dim, scale), schema)
        for r in partial.repartition("part", "entry").mapInArrow(_add_up, schema).collect():
            n, *sums = map(int, r.sums)
            books[r.part][r.entry] = [c // n for c in sums]
    return books


def codebooks_sha256(books: Codebooks) -> str:
    """Checksum of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()


def _encode(vector: str, books: Codebooks, dim: int, scale: int, carry: list[str]):
    """Task: the carried columns of the vectors that count, with their codes and errors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, fits, matrix in blocks(batches, vector, dim, scale):
            codes = np.empty((len(matrix), len(books)), np.uint8)
            errors = 0
            for p, (trie, entry, distance, _) in enumerate(assign(matrix, books)):
                codes[:, p] = entry[trie.leaf_of_row]
                errors = errors + distance[trie.leaf_of_row]
            text, error = np.full(len(fits), None, object), np.full(len(fits), None, object)
            text[fits] = [row.tobytes().hex() for row in codes]
            error[fits] = [int(e) if e < _LONG else None for e in errors] if len(matrix) else []
            columns = [batch.column(c) for c in carry] + [pa.array(text, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "code", "error"])

    return work


def encode(
    vectors: DataFrame, books: Codebooks, vector: str = "embedding", carry: list[str] | None = None, scale: int = SCALE
) -> DataFrame:
    """Every vector that counts, with its code (two hex digits a part) and error; `carry` defaults to all other columns."""
    rows = without(vectors.withColumn("_q_vector", F.col(vector)), (*_OUTPUTS, *([] if carry else [vector])))
    names = [c for c in rows.columns if c != "_q_vector" and (carry is None or c in carry)]
    rows = rows.select(*[F.col(f"`{c}`") for c in names], "_q_vector")
    schema = T.StructType([f for f in rows.schema if f.name != "_q_vector"])
    schema = schema.add("code", T.StringType()).add("error", T.LongType())
    if not books:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = sum(len(book[0]) for book in books)
    return rows.mapInArrow(_encode("_q_vector", books, dim, scale, names), schema)


def compress(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", carry: list[str] | None = None,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """Vectors with code, error, label_error (the error summed over equal labels, nulls together) and codebooks_sha256."""
    books = fit_codebooks(vectors, vector, key, parts, entries, rounds, scale)
    wanted = None if carry is None else list(dict.fromkeys([*carry, label]))
    encoded = written(encode(vectors, books, vector, wanted, scale), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    by_label = broadcast_if_small(encoded.groupBy(F.col(label).alias("_q_label")).agg(total.alias("label_error")))
    out = encoded.join(by_label, F.col(label).eqNullSafe(F.col("_q_label"))).drop("_q_label")
    columns = [c for c in encoded.columns if carry is None or c in carry or c in ("code", "error")]
    return out.select(*[F.col(f"`{c}`") for c in columns], "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
