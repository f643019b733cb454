"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from quayside.llm import phrases
from quayside.llm.phrases import collocations, count_runs, escaped, frequent_phrases, phrase_runs, unescaped

SCHEMA = "doc_id long, text string, lang string, n long, rank string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """Counts by language of all phrases of 1 to 4 words, as tuples."""
    out = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for i in range(len(words)):
                for size in range(1, min(4, len(words) - i) + 1):
                    out[lang or "und" if lang is None else lang][tuple(words[i : i + size])] += 1
    return out


def brute(rows, least=30, top=2000):
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        covered = set()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * c >= 80 * f[p[i : i + size]]:
                        covered.add(p[i : i + size])
        found = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0, "x") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def some_texts(n, seed=1, words="a b c Dd eé the the ü\x01 x\x7f \x05y".split(" ")):
    rnd = random.Random(seed)
    seps = [" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\r\n", "; ", " \x0b", "! "]
    return ["".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.randrange(60))) for _ in range(n)]


ODD = [
    (None, "en"), ("", "en"), (" \t\n", None), ("one,two", "und"), ("A B c d", "en"), ("", ""), ("the the the the the", ""),
]


def test_every_case(spark):
    rows = [(t, random.Random(i).choice(["en", "en", None, "und", "de"])) for i, t in enumerate(some_texts(300))] + ODD * 2
    assert got(collocations(frame(spark, rows), least=4, top=40)) == brute(rows, 4, 40)


@pytest.mark.parametrize("limits", [dict(BURST=3, HELD=40, LEAVING=7, CHUNK=64, BLOCK=50), dict(BURST=2, SHARED=2), dict(VOCABULARY=6, CHUNK=64, BLOCK=50)])
def test_small_limits(monkeypatch, limits):
    """Bursting, spilling, a full vocabulary and cut texts change no count."""
    import pyarrow as pa

    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    rows = [(t, "en" if i % 3 else "de") for i, t in enumerate(some_texts(60, 2))] + [(" ".join(some_texts(30, 3)), "en")]
    batches = [pa.RecordBatch.from_pydict({"lang": [r[1] for r in part], "text": [r[0] for r in part]}) for part in (rows[:40], rows[40:])]
    expected, found = counted(rows), defaultdict(Counter)
    runs = list(count_runs(iter(batches)))
    assert len(runs) > 1
    for run in runs:
        assert run["key"].to_pylist() == sorted(run["key"].to_pylist(), key=str.encode)
        for r in run.to_pylist():
            lang, phrase = r["key"].split("\t")
            words = [unescaped(w.encode()).decode() for w in phrase.split(" ")]
            for size in range(1, len(words) + 1):
                found[lang][tuple(words[:size])] += r["n"]
    assert found == expected


def test_ranges_split_prefixes(spark, monkeypatch):
    """Phrases of one frequent prefix lie in many ranges, with one batch a row: sums are whole."""
    rows = [(t, "en") for t in some_texts(200, 4)]
    monkeypatch.setattr(phrases, "HELD", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = frequent_phrases(phrase_runs(frame(spark, rows)), 2).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = [r for r in found if r.words]
    expected = {" ".join(p): (len(p), c) for p, c in counted(rows)["en"].items() if c >= 2}
    assert {r.phrase: (r.words, r.n) for r in found} == expected and len(found) == len(expected)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: counts of ten trillion."""
    from quayside.llm.phrases import score_phrases

    a, l, r = 9 * 10**12, 9 * 10**12 + 7, 10**13 + 1
    counts = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r)], "lang string, phrase string, words int, n long")
    [row] = score_phrases(counts).collect()
    assert row.score == 2000000 * a // (l + r)


def test_empty(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, ODD)).count() == 0


def test_escapes_keep_order():
    words = [b"a", b"a\x01", b"a\x7f", b"a\x7fA", b"\x00", b"a \t", "é".encode()]
    assert [unescaped(escaped(w)) for w in words] == words and len(set(map(escaped, words))) == len(words)
    assert all(min(escaped(w)) > 0x20 for w in words)
