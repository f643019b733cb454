"""Host-level quality rules: failures aggregated by host, rates shrunk with an empirical beta prior, verdicts joined back.

Words are `[^\\x20\\x09-\\x0D]+` of the whole text. Base rules fail a document by itself: fewer than 50 words, or more
than half of its words in three-word windows that the text holds twice or more. Soft rules (many symbols, many repeated
lines, very short or long words) only count towards the host. A host's rate of failing documents is shrunk to
(failures + a) / (documents + a + b), with a and b of the beta prior fitted to all hosts by moments. On a host whose
shrunk rate reaches `host_limit`, documents that fail a soft rule go too; documents without a failure always stay.

One pass counts per host (partial sums move, never documents); a second joins the host table, broadcast if its counted
rows allow it, and no document is shuffled.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; equal rows are judged
alike; an empty table gives an empty result; columns of the input that have the name of an output give way to it.
Repeats are found by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import broadcast_if_small, written
from .text import BYTE_CODES, NON_SPACE, SMALL_SLICE_BYTES, covered, flat, gram_hashes, inside_one, mix, per_text, slices, span_hashes, spans, without

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
WORD_CHARS = (2, 12)
HOST_LIMIT = 0.6

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_OUTPUTS = (*COUNTS, "base_failed", "soft_failed", "host_rate", "host_failed", "kept")

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False
_OWNER = np.uint64(0xA24BAED4963EE407)


def _later_equals(owner: np.ndarray, hashes: np.ndarray, first_too: bool) -> np.ndarray:
    """Which entries equal an earlier one of the same owner; with first_too, also the first of each such set."""
    keys = mix(hashes + owner.astype(np.uint64) * _OWNER)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    if first_too:
        flags[order[:-1][same]] = True
    return flags


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """COUNTS of each text."""
    data, offsets = flat(texts)
    starts, ends, n_words = spans(data, offsets, NON_SPACE)
    words = span_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    grams = gram_hashes(words, 3)
    at = np.flatnonzero(inside_one(n_words, 3))
    twice = at[_later_equals(owner[at], grams[at], True)] if len(at) else at
    firsts = np.concatenate([[0], np.cumsum(n_words)])
    repeated = per_text(covered(twice, 3, len(words)), firsts)
    low, high, _ = spans(data, offsets, _LINE)
    worded = np.searchsorted(starts, high) > np.searchsorted(starts, low)
    low, high = low[worded], high[worded]
    line_owner = np.searchsorted(offsets, low, "right") - 1
    again = _later_equals(line_owner, span_hashes(data, low, high), False)
    n_texts = len(n_words)
    lines = np.bincount(line_owner, minlength=n_texts)
    dup_lines = np.bincount(line_owner[again], minlength=n_texts)
    chars = per_text(NON_SPACE[data] & _FIRST_BYTE[data], offsets)
    return [n_words, chars, per_text(_SYMBOLS[data], offsets), dup_lines, repeated, lines]


def _counter(text: str, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SMALL_SLICE_BYTES):
            counts = [pa.array(c.astype(np.int64)) for c in text_counts(batch.column(text))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + counts, names=[*columns, *COUNTS])

    return work


def with_rules(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` (default: all) of docs with COUNTS, base_failed and soft_failed."""
    base = without(docs, _OUTPUTS)
    carry = base.columns if carry is None else carry
    schema = T.StructType([*(T.StructField(base.schema[c].name, base.schema[c].dataType) for c in carry), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    needed = list(dict.fromkeys([*carry, text]))
    counted = base.select(*needed).mapInArrow(_counter(text, carry), schema)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    soft = (
        (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"))
        | (F.col("word_chars") < WORD_CHARS[0] * F.col("n_words"))
        | (F.col("word_chars") > WORD_CHARS[1] * F.col("n_words"))
    )
    return counted.withColumn("base_failed", base_failed).withColumn("soft_failed", soft)


def host_verdicts(ruled: DataFrame, host: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """host, documents, failures, host_rate and host_failed for each host of a frame of `with_rules`.

    The prior's mean is the mean host rate; its strength follows from the variance between hosts less what
    sampling alone explains, between 1 and 10,000 documents.
    """
    failed = F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long"))
    hosts = written(ruled.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("documents"), failed.alias("failures")), "hosts")
    rate = F.col("failures") / F.col("documents")
    m, v, s = hosts.agg(F.avg(rate), F.var_pop(rate), F.avg(1 / F.col("documents"))).first()
    m, v, s = m or 0.0, v or 0.0, s or 0.0
    spread = m * (1 - m)
    between = max(v - spread * s, 0.0)
    strength = min(max(spread / between - 1, 1.0), 10_000.0) if between > 0 else 10_000.0
    shrunk = (F.col("failures") + m * strength) / (F.col("documents") + strength)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") >= host_limit)


def judge(docs: DataFrame, *, text: str = "text", host: str = "source", carry: list[str] | None = None, host_limit: float = HOST_LIMIT) -> DataFrame:
    """The columns `carry` (default: all) of docs with the counts, base_failed, soft_failed, host_rate, host_failed, kept."""
    hosts = host_verdicts(with_rules(docs, text=text, carry=[host]), host, host_limit)
    verdicts = broadcast_if_small(hosts.select(F.col("host").alias("_q_host"), "host_rate", "host_failed"))
    ruled = with_rules(docs, text=text, carry=carry and list(dict.fromkeys([*carry, host])))
    judged = ruled.join(verdicts, F.col(host).eqNullSafe(F.col("_q_host")), "left").drop("_q_host")
    return judged.withColumn("kept", ~(F.col("base_failed") | (F.col("host_failed") & F.col("soft_failed"))))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that `judge` keeps, in their own columns."""
    return judge(docs, **options).where("kept").select(*without(docs, _OUTPUTS).columns)
