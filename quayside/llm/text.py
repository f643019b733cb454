"""Words and their 64-bit hashes over whole Arrow text columns, in numpy.

Helpers of the Python operators. They run inside `mapInArrow` tasks; nothing here keeps more than a slice
of a batch (`slices`) plus eight bytes a word in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 21
#: Where a worker takes tens of bytes for each byte of text, and keeps them for the tasks after.
SMALL_SLICE_BYTES = 1 << 20
_CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: a bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
LOWER_CODES = BYTE_CODES.copy()
LOWER_CODES[ord("A") : ord("Z") + 1] = BYTE_CODES[ord("a") : ord("z") + 1]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; made where they are used, so that task code stays small."""
    if not _TABLES:
        _TABLES["powers"] = powers(_BASE, _CHUNK + 1)
        _TABLES["inverses"] = powers(_BASE_INVERSE, _CHUNK + 1)
    return _TABLES["powers"], _TABLES["inverses"]


#: Bytes of words: ASCII letters and digits and every non-ASCII byte (op 2's class, case aside).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Every byte but ASCII white space.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[0x20] = False
NON_SPACE[0x09:0x0E] = False


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `size` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of `inside` bytes that do not cross texts, and runs per text."""
    mask = inside[data]
    n = len(data)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    begin[cuts] = mask[cuts]
    end = mask
    end[:-1] &= ~mask[1:] | begin[1:]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    scales, inverses = tables()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        if high - low > _CHUNK:
            out[at] = _long_hash(data[low:high], codes)
        else:
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(codes[data[low:high]] * scales[: high - low], out=sums[1:])
            s = starts[at:to] - low
            out[at:to] = (sums[ends[at:to] - low] - sums[s]) * inverses[s]
        at = to
    return mix(out + (ends - starts).astype(np.uint64) * _GRAM)


def _long_hash(piece: np.ndarray, codes: np.ndarray) -> np.uint64:
    """The same sum for one span longer than a chunk."""
    scales, _ = tables()
    total, scale = 0, 1
    step = int(scales[_CHUNK])
    for low in range(0, len(piece), _CHUNK):
        part = piece[low : low + _CHUNK]
        here = int(np.sum(codes[part] * scales[: len(part)], dtype=np.uint64))
        total = (total + here * scale) & 0xFFFFFFFFFFFFFFFF
        scale = scale * step & 0xFFFFFFFFFFFFFFFF
    return np.uint64(total)


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of `width` consecutive words at each position that has so many left (texts run together)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out *= _GRAM
        out += words[k : k + n]
    return mix(out)


def inside_one(counts: np.ndarray, width: int) -> np.ndarray:
    """Which of the positions of `gram_hashes` have all their words in one text."""
    n = int(counts.sum()) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(np.cumsum(counts), counts)[:n]
    return np.arange(n) + width <= ends


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags over each text's range."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a run of `width` from one of `starts`."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return np.cumsum(edges[:n]) > 0


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df less the columns of these names in any case: an operator's own outputs win over clashing inputs."""
    gone = {n.lower() for n in names}
    return df.select([df[f"`{c.replace('`', '``')}`"] for c in df.columns if c.lower() not in gone])


def map_batches(
    df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    return df.mapInArrow(work, schema)
