"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, hits verified, spans or documents removed.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is `window` consecutive words of
an item; an item with fewer words, but not none, is one window. A document word inside any occurrence of a window is hit.
A document is contaminated if it has a hit and its hit words are at least `min_share` of its words.

Windows of all items are hashed into sorted arrays that every task holds. Their size is checked: beyond
`broadcast_windows` the items are dealt into slices by hash, and the documents pass one slice after another with their
hits so far carried along, written to the shared folder in between. No row of a document is ever shuffled.

Defined cases: a null or empty text has no words, no hits and stays; an empty benchmark hits nothing; equal item ids
count once; an item with a null id is hit but not listed; equal rows are judged alike; columns of the input that have
the name of an output give way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written
from .text import ALNUM, LOWER_CODES, SMALL_SLICE_BYTES, covered, flat, gram_hashes, inside_one, slices, span_hashes, spans, without

WINDOW = 13
MIN_SHARE = 0.05
#: Windows a task holds at once: 40 bytes each, and the items' texts to verify hits.
BROADCAST_WINDOWS = 2_000_000

_OUTPUTS = {
    "n_words": T.LongType(), "n_hit": T.LongType(), "n_items": T.LongType(), "items_sha256": T.StringType(),
    "contaminated": T.BooleanType(), "hit_words": T.ArrayType(T.LongType()), "hit_items": T.ArrayType(T.StringType()),
}


class Windows:
    """The windows of some items: sorted hashes by length, and where each stands, to verify a hit."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.ids = [i for i, _ in items]
        data, offsets = flat(pa.array([t for _, t in items], pa.large_string()))
        self.starts, self.ends, counts = spans(data, offsets, ALNUM)
        self.text = data.tobytes().lower()
        words = span_hashes(data, self.starts, self.ends, LOWER_CODES)
        self.owner = np.repeat(np.arange(len(counts)), counts)
        widths = np.minimum(counts, window)
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in np.unique(widths[widths > 0]).tolist():
            at = np.flatnonzero(inside_one(counts, width) & (widths[self.owner] == width)[: len(words) - width + 1])
            hashes = gram_hashes(words, width)[at]
            order = np.argsort(hashes, kind="stable")
            self.by_width[width] = (hashes[order], at[order])

    def _words(self, p: int, width: int) -> list[bytes]:
        return [self.text[a:b] for a, b in zip(self.starts[p : p + width], self.ends[p : p + width], strict=True)]

    def hits(self, data, starts, ends, counts, words) -> tuple[np.ndarray, dict[int, set]]:
        """Hit flag of each word, and the items found by text."""
        flags = np.zeros(len(words), bool)
        found: dict[int, set] = {}
        owner = np.repeat(np.arange(len(counts)), counts)
        for width, (hashes, places) in self.by_width.items():
            grams = gram_hashes(words, width)
            at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
            sure = []
            for p in np.flatnonzero((hashes[at] == grams) & inside_one(counts, width)).tolist():
                own = [data[a:b].tobytes().lower() for a, b in zip(starts[p : p + width], ends[p : p + width], strict=True)]
                k = at[p]
                while k < len(hashes) and hashes[k] == grams[p]:
                    if self._words(places[k], width) == own:
                        found.setdefault(int(owner[p]), set()).add(self.ids[self.owner[places[k]]])
                        sure.append(p)
                    k += 1
            if sure:
                flags |= covered(np.unique(sure), width, len(words))
        return flags, found


def _matcher(items, window: int, text: str, columns: list[str], more: bool, min_share: tuple[int, int]):
    """Task code. With `more`, hits of an earlier slice of the benchmark come along in the output columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(items.value, window)
        for batch in slices(batches, text, SMALL_SLICE_BYTES):
            data, offsets = flat(batch.column(text))
            starts, ends, counts = spans(data, offsets, ALNUM)
            words = span_hashes(data, starts, ends, LOWER_CODES)
            flags, found = windows.hits(data, starts, ends, counts, words)
            firsts = np.concatenate([[0], np.cumsum(counts)])
            if more:
                for k, (old, ids) in enumerate(zip(batch.column("hit_words").to_pylist(), batch.column("hit_items").to_pylist(), strict=True)):
                    flags[firsts[k] + np.array(old, np.int64)] = True
                    if ids:
                        found.setdefault(k, set()).update(ids)
            marked = np.flatnonzero(flags)
            n_hit = np.diff(np.searchsorted(marked, firsts))
            named = [sorted(i for i in found.get(k, ()) if i is not None) for k in range(batch.num_rows)]
            local = marked - np.repeat(firsts[:-1], n_hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [
                    pa.array(counts, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in named], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in named]),
                    pa.array((n_hit > 0) & (min_share[1] * n_hit >= min_share[0] * counts)),
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_hit)]).astype(np.int32), pa.array(local, pa.int64())),
                    pa.array(named, pa.list_(pa.string())),
                ],
                names=[*columns, *_OUTPUTS],
            )

    return work


def _normal(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, min_share: float = MIN_SHARE, broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated, hit_words (word numbers) and hit_items."""
    spark = docs.sparkSession
    share = min_share.as_integer_ratio() if min_share != MIN_SHARE else (1, 20)
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    size = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]  # a window starts at a word, so fewer
    parts = -(-(size // 2 + 1) // broadcast_windows)
    base = without(docs, _OUTPUTS)
    columns = base.columns
    schema = T.StructType([*_normal(base), *(T.StructField(n, t) for n, t in _OUTPUTS.items())])
    out = base
    for k in range(parts):
        rows = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        held = spark.sparkContext.broadcast([(r.i, r.t) for r in rows.collect()])
        if k:
            out = written(out, "contamination")
        out = out.mapInArrow(_matcher(held, window, text, columns, k > 0, share), schema)
    return out


def _cutter(text: str, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = flat(batch.column(text))
            starts, ends, counts = spans(data, offsets, ALNUM)
            firsts = np.concatenate([[0], np.cumsum(counts)])
            texts = []
            for k, (value, hit) in enumerate(zip(batch.column(text).to_pylist(), batch.column("hit_words").to_pylist(), strict=True)):
                if hit:
                    at = firsts[k] + np.array(hit, np.int64)
                    keep = np.ones(offsets[k + 1] - offsets[k], bool)
                    breaks = np.flatnonzero(np.diff(at) != 1)
                    for a, b in zip(np.r_[at[0], at[breaks + 1]], np.r_[at[breaks], at[-1]], strict=True):
                        keep[starts[a] - offsets[k] : ends[b] - offsets[k]] = False
                    value = data[offsets[k] : offsets[k + 1]][keep].tobytes().decode()
                texts.append(value)
            arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return work


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """docs, in their own columns, without contaminated documents or without the hit spans of every document.

    A span runs from the first to the last hit word of a run, with what lies between.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = find_contamination(docs, benchmark, text=text, **options)
    columns = [c for c in docs.columns if c.lower() not in _OUTPUTS]
    if remove == "documents":
        return found.where("not contaminated").select(*columns)
    kept = found.select(*columns, "hit_words")
    return kept.mapInArrow(_cutter(text, columns), _normal(found.select(*columns)))
