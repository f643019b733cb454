"""Exact duplicates against a dictionary of texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from quayside.llm import copies
from quayside.llm.copies import drop_copies, frequent, mark_copies, winners
from quayside.llm.store import table

SCHEMA = "doc_id long, text string, kept string, extra int"


def brute(rows):
    groups = defaultdict(list)
    for i, (key, text, *_) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append((key is None, key or 0, i))
    out = []
    for text, members in groups.items():
        least = min(members)
        for none, key, i in members:
            out.append((None if none else key, None if least[0] else least[1], len(members),
                        i == least[2], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def marked(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


ROWS = [
    (5, "a  b", "x", 1), (3, "a\tb", "x", 2), (9, "a b ", "x", 3), (4, " a b", "x", 4),
    (7, None, "x", 5), (2, "", "x", 6), (8, " ", "x", 7), (8, "\n\r", "x", 8),
    (None, "a b", "x", 9), (None, "only null", "x", 10), (None, "only null", "x", 11),
    (6, "same", None, 1), (6, "same", None, 2), (6, "same", None, 3),
    (11, "é x", "x", 1), (12, "é x", "x", 1), (13, "long " * 50_000, "x", 1), (1, "long  " * 50_000, "x", 1),
]


@pytest.mark.parametrize("share", [1, 4, 4096])
def test_every_case(spark, monkeypatch, share):
    """Whether groups are heavy or not, the decisions are the same."""
    monkeypatch.setattr(copies, "HEAVY_SHARE", share)
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = mark_copies(docs)
    assert got.columns == ["doc_id", "text", "extra", "keep_id", "group_size", "kept", "text_sha256"]
    assert marked(got) == brute(ROWS)


def test_drop(spark):
    kept = drop_copies(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "extra"]
    assert kept.count() == len({r[4] for r in brute(ROWS)})


def test_empty(spark):
    assert mark_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_group(spark, monkeypatch):
    """A third of all rows are copies of one text: the summary names it and only it, and no shuffle moves its rows."""
    monkeypatch.setattr(copies, "HEAVY_SHARE", 10)
    docs = spark.range(30_000).selectExpr("id doc_id", "case when id % 3 = 1 then 'copy' else concat('t', id) end text")
    digests = docs.selectExpr("unhex(sha2(text, 256)) _q_sha", "struct(false none, doc_id key, doc_id row) _q_first")
    assert frequent(digests, 3000).count() == 1
    [winner] = winners(digests, 3000).collect()
    assert (winner._q_first.key, winner._q_size) == (1, 10_000)
    got = mark_copies(docs)
    assert got.where("kept").count() == 20_001
    assert got.where("group_size = 10000 and keep_id = 1").count() == 10_000
    plan = got._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert marked(mark_copies(docs)) == brute(rows)
