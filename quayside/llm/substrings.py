"""Exact-substring dedup: every byte under a 400-byte string that also starts anywhere else is removed.

The suffixes that can tie over 400 bytes are brought together in buckets and decided one bucket at a time. A suffix
belongs to the bucket of its anchor: the leftmost least 300-byte gram (by hash) among the 101 grams of its first 400
bytes. The anchor depends on those bytes alone, so equal strings have equal anchors at equal distance: the anchors are
the cover sample. (A difference cover samples by position; two strings then meet at a sample that depends on both
positions, which cannot key a shuffle, and all suffixes would have to be sorted together, 16 bytes for each byte of
text. See the README.) An anchor stands for the run of suffixes that have it, 50 on average.

1. Anchor hashes are counted; an anchor that occurs once settles its suffixes as unique.
2. For the others, the long ties are resolved by ranks computed beforehand: the hash of the whole context, from the
   first suffix of the run to the end of the last string. Equal contexts are repeated throughout.
3. What remains are buckets with several contexts. Their contexts, one for each different one, are cut from the texts
   and the strings at each distance compared within the bucket; buckets of more than `BUCKET` contexts are dealt out
   by string instead, so no bucket has to fit a task.

Texts are UTF-8 bytes and strings never cross texts; equal texts give equal results and are keyed by their digest.

Defined cases: a null or empty text has no bytes, no spans and the checksum of no bytes; texts under 400 bytes lose
nothing; equal rows of 400 bytes or more lose everything; an empty table gives an empty result; columns of the input
that have the name of an output give way to it.
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
from .text import BYTE_CODES, flat, mix, powers, slices, without

LENGTH = 400
GRAM = 300
GRAMS = LENGTH - GRAM + 1
BUCKET = 4096
#: Anchor hashes, or anchors whose contexts are cut, that may be broadcast.
BROADCAST_HASHES = 2_000_000
_CHUNK = 1 << 18
_SLICE = 1 << 21
_OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MARK = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLES: dict[str, np.ndarray] = {}


def _scales() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        n = _CHUNK + 2 * LENGTH + 2
        _TABLES["up"] = powers(_BASE, n)
        _TABLES["down"] = powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), n)
    return _TABLES["up"], _TABLES["down"]


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * _scales()[0][: len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _scales()[1][starts])


def _windowed(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each `width` consecutive values."""
    fold = np.minimum if least else np.maximum
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max if least else 0, np.uint64)
    padded[:n] = x
    grid = padded.reshape(-1, width)
    ahead = fold.accumulate(grid, axis=1).ravel()
    behind = np.ascontiguousarray(fold.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
    m = n - width + 1
    return fold(behind[:m], ahead[width - 1 : width - 1 + m])


def _runs(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of string starts that share an anchor: first and last start, anchor, its hash, hash of the context.

    valid flags the starts of strings that lie in one text; data goes LENGTH bytes beyond the last start.
    """
    sums = _sums(data)
    n = len(data) - GRAM + 1
    at = np.arange(n)
    gram = _hashes(sums, at, at + GRAM)
    least = _windowed(gram, GRAMS, True)
    valid = valid[: len(least)]
    edge = np.zeros(GRAMS - 1, np.uint64)
    anchors = np.flatnonzero(_windowed(np.concatenate([edge, np.where(valid, least, 0), edge]), GRAMS, False)[:n] == gram)
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    end = valid.copy()
    end[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    first, last = np.flatnonzero(begin), np.flatnonzero(end)
    found = []
    while len(first):
        k = np.searchsorted(anchors, first)
        wrong = np.flatnonzero(gram[anchors[k]] != least[first])
        while len(wrong):
            k[wrong] += 1
            wrong = wrong[gram[anchors[k[wrong]]] != least[first[wrong]]]
        anchor = anchors[k]
        found.append((first, np.minimum(last, anchor), anchor))
        more = last > anchor
        first, last = anchor[more] + 1, last[more]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    first, last, anchor = (np.concatenate(x) for x in zip(*found, strict=True))
    context = _hashes(sums, first, last + LENGTH)
    context = mix(context + (anchor - first).astype(np.uint64) * _MARK + (anchor - last).astype(np.uint64) * _BASE)
    return first, last, anchor, gram[anchor], context


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each anchor of each text: digest, hash, context, first and last start, anchor (byte offsets)."""
    for batch in slices(batches, "text", _SLICE):
        data, offsets = flat(batch.column("text"))
        ends = np.repeat(offsets[1:], np.diff(offsets))
        digests = batch.column("digest")
        for low in range(0, len(data), _CHUNK):
            high = min(low + _CHUNK, len(data) - LENGTH + 1)
            if high <= low:
                break
            starts = np.arange(low, high)
            first, last, anchor, h, context = _runs(data[low : high + LENGTH - 1], starts + LENGTH <= ends[low:high])
            owner = np.searchsorted(offsets, first + low, "right") - 1
            base = low - offsets[owner]
            yield pa.RecordBatch.from_arrays(
                [
                    digests.take(pa.array(owner)),
                    pa.array(h.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    pa.array(first + base),
                    pa.array(last + base),
                    pa.array(anchor + base),
                ],
                names=["digest", "h", "context", "first", "last", "anchor"],
            )


def _string_hashes(contexts: list[bytes], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context number, distance to the anchor and hash of every string; first and last are distances."""
    owner, distance, hashes = [], [], []
    for k, context in enumerate(contexts):
        n = int(first[k] - last[k]) + 1
        at = np.arange(n)
        hashes.append(_hashes(_sums(np.frombuffer(context, np.uint8)), at, at + LENGTH))
        owner.append(np.full(n, k))
        distance.append(first[k] - at)
    return np.concatenate(owner), np.concatenate(distance), np.concatenate(hashes)


def _ranges(owner: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, greatest and least distance of runs; entries come by owner and falling distance."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (distance[1:] != distance[:-1] - 1)
    begin = np.flatnonzero(new)
    end = np.append(begin, len(owner))[1:] - 1
    return owner[begin], distance[begin], distance[end]


def _bucket(table: pa.Table) -> pa.Table:
    """The repeated strings of one bucket, as ranges of distances for each context."""
    owner, distance, h = _string_hashes(
        table.column("bytes").to_pylist(), table.column("far").to_numpy(), table.column("near").to_numpy()
    )
    key = mix(h + distance.astype(np.uint64) * _MARK)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    flags = np.zeros(len(key), bool)
    flags[order[1:][same]] = flags[order[:-1][same]] = True
    who, far, near = _ranges(owner[flags], distance[flags])
    return pa.table({"h": table.column("h").take(pa.array(who)), "context": table.column("context").take(pa.array(who)), "far": far, "near": near})


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each string of each context: the way of the very large buckets."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            owner, distance, h = _string_hashes(batch.column("bytes").to_pylist(), batch.column("far").to_numpy(), batch.column("near").to_numpy())
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h").take(take), batch.column("context").take(take), pa.array(distance), pa.array(h.view(np.int64))],
                names=["h", "context", "distance", "string"],
            )


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SLICE):
        data, offsets = flat(batch.column("text"))
        for k, places in enumerate(batch.column("places").to_pylist()):
            own = data[offsets[k] : offsets[k + 1]]
            for at in range(0, len(places), 4096):
                some = places[at : at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p["h"] for p in some], pa.int64()),
                        pa.array([p["context"] for p in some], pa.int64()),
                        pa.array([p["anchor"] - p["first"] for p in some], pa.int64()),
                        pa.array([p["anchor"] - p["last"] for p in some], pa.int64()),
                        pa.array([own[p["first"] : p["last"] + LENGTH].tobytes() for p in some], pa.binary()),
                    ],
                    names=["h", "context", "far", "near", "bytes"],
                )


def _small(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    return F.broadcast(df) if (df if rows is None else rows).count() <= BROADCAST_HASHES else df


def find_repeats(texts: DataFrame) -> DataFrame:
    """(digest, ranges): start ranges [first, last] of the repeated strings of each text of (digest, text)."""
    found = texts.mapInArrow(_anchors, "digest binary, h long, context long, first long, last long, anchor long")
    hashes = written(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "anchor-hashes")
    # Copies of a text are counted, not listed.
    again = found.join(_small(hashes), "h", "left_semi").groupBy("digest", "h", "context", "first", "last", "anchor").agg(F.count("*").alias("n"))
    anchors = written(again, "anchors")
    contexts = anchors.groupBy("h", "context").agg(F.sum("n").alias("n"), F.min(F.struct("digest", "first", "last", "anchor")).alias("place"))
    contexts = written(contexts.select("h", "context", "n", "place.*"), "contexts")
    buckets = contexts.groupBy("h").agg(F.count("*").alias("size"), F.min("n").alias("least")).where("size > 1 and least = 1").select("h", "size")
    open_ = contexts.join(buckets, "h")
    places = open_.groupBy("digest").agg(F.collect_list(F.struct("h", "context", "first", "last", "anchor")).alias("places"))
    places = written(places, "places")
    cut = texts.join(_small(places, contexts), "digest").select("text", "places").mapInArrow(_cutter, "h long, context long, far long, near long, bytes binary")
    cut = cut.groupBy("h", "context").agg(F.first("far").alias("far"), F.first("near").alias("near"), F.first("bytes").alias("bytes"))
    cut = written(cut.join(buckets, "h"), "cut")
    out = "h long, context long, far long, near long"
    compared = cut.where(F.col("size") <= BUCKET).select("h", "context", "far", "near", "bytes").groupBy("h").applyInArrow(_bucket, out)
    strings = cut.where(F.col("size") > BUCKET).select("h", "context", "far", "near", "bytes").mapInArrow(_strings, "h long, context long, distance long, string long")
    repeated = strings.groupBy("h", "distance", "string").agg(F.count("*").alias("n")).where("n > 1").select("h", "distance", "string")
    dealt = strings.join(repeated, ["h", "distance", "string"]).select("h", "context", F.col("distance").alias("far"), F.col("distance").alias("near"))
    settled = written(compared.unionAll(dealt), "settled")
    alike = contexts.where("n > 1").select("h", "context")
    whole = anchors.join(alike, ["h", "context"]).select("digest", "first", "last")
    partly = anchors.join(settled, ["h", "context"]).select("digest", (F.col("anchor") - F.col("far")).alias("first"), (F.col("anchor") - F.col("near")).alias("last"))
    return whole.unionAll(partly).groupBy("digest").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def _remover(columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_q_text", _SLICE):
            data, offsets = flat(batch.column("_q_text"))
            rows = []
            for k, ranges in enumerate(batch.column("ranges").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                n = len(own)
                gone: list[tuple[int, int]] = []
                for r in sorted((r["first"], r["last"] + LENGTH) for r in ranges or ()):
                    if gone and r[0] <= gone[-1][1]:
                        gone[-1] = (gone[-1][0], max(gone[-1][1], r[1]))
                    else:
                        gone.append(r)
                keep = np.ones(n, bool)
                for a, b in gone:
                    keep[a:b] = False
                left = own[keep].tobytes() if gone else own.tobytes()
                rows.append((n, int(n - len(left)), len(gone), hashlib.sha256(left).hexdigest(), [{"first": a, "last": b} for a, b in gone]))
            n, removed, spans, sha, ranges = map(list, zip(*rows, strict=True))
            arrays = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
            arrays.append(pa.array(ranges, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + arrays, names=[*columns, *_OUTPUTS])

    return work


def remove_repeats(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` (default: all) of docs with n_bytes, n_removed, n_spans, kept_sha256 and removed.

    removed lists the byte ranges [first, last) that go; the bytes that stay need not be valid UTF-8.
    """
    base = without(docs, (*_OUTPUTS, "_q_text", "_q_digest"))
    carry = base.columns if carry is None else carry
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    found = written(find_repeats(base.select(digest.alias("digest"), F.col(text).alias("text"))), "repeats")
    held = found.select(F.col("digest").alias("_q_digest"), "ranges").hint("merge")
    rows = base.select(*carry, F.col(text).alias("_q_text"), digest.alias("_q_own"))
    rows = rows.join(held, F.col("_q_own") == F.col("_q_digest"), "left").select(*carry, "_q_text", "ranges")
    fields = [T.StructField(base.schema[c].name, base.schema[c].dataType) for c in carry]
    fields += [T.StructField(n, T.LongType()) for n in _OUTPUTS[:3]] + [T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("removed", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))]
    return rows.mapInArrow(_remover(carry), T.StructType(fields))
