from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from quayside.llm import mix as X


def spark_hash(*values):
    """The engine's 64-bit hash of longs and strings, nulls left out."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(rows, max_repetition, block_tokens, target_entropy=None, budget=None):
    """(doc, source, copy, block) of every taken copy."""
    rows = [(d, s, len(re.findall(r"\S+", t or "", re.ASCII))) for d, t, s in rows]
    rows = [r for r in rows if r[2]]
    total = Counter()
    for _, s, n in rows:
        total[s] += n
    share = {s: n / sum(total.values()) for s, n in total.items()}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    def spent(w):
        return max(total[s] / w[s] for s in w) if budget is None else budget

    def enough(a):
        w = weights(a)
        if target_entropy is not None:
            return -sum(p * math.log(p) for p in w.values()) <= target_entropy
        return max(w[s] * spent(w) / total[s] for s in w) <= max_repetition * (1 + 1e-12)

    low, high = 0.0, 1.0
    if enough(0.0):
        high = 0.0
    else:
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (low, mid) if enough(mid) else (mid, high)
    w = weights(high)
    budgets = {s: round(w[s] * spent(w)) for s in w}
    blocks = max(1, -(-sum(budgets.values()) // block_tokens))
    size = Counter(s for _, s, _ in rows)
    by = defaultdict(list)
    for d, s, n in rows:
        h = spark_hash(s, d)
        bucket = ((h % (1 << 64)) >> 20) % (-(-size[s] // X.BUCKET_ROWS))
        by[s].append((bucket, h, n, d))
    out = []
    for s, own in by.items():
        at = 0
        for _, _, n, d in sorted(own, key=lambda x: x[:3]):
            for copy in range(budgets[s] // total[s] + (at < budgets[s] % total[s])):
                out.append((d, s, copy, min(int((copy * total[s] + at) / budgets[s] * blocks), blocks - 1)))
            at += n
    return out, w, budgets


def pairs(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("options", [{}, {"max_repetition": 1.0}, {"max_repetition": 5.0}, {"target_entropy": 0.9}, {"budget": 9000.0}])
def test_matches_brute_force(edge, monkeypatch, options):
    monkeypatch.setattr(X, "BUCKET_ROWS", 5)
    got = X.mix(edge, block_tokens=1000, **options).collect()
    want, *_ = brute(pairs(edge), options.get("max_repetition", 2.0), 1000, options.get("target_entropy"), options.get("budget"))
    assert Counter((r.doc_id, r.source, r.copy, r.block) for r in got) == Counter(want)
    places = defaultdict(list)
    for r in got:
        places[r.block].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_documents(docs):
    got = X.mix(docs, carry=["doc_id", "source"])
    want, weights, budgets = brute(pairs(docs), X.MAX_REPETITION, X.BLOCK_TOKENS)
    assert Counter((r.doc_id, r.source, r.copy, r.block) for r in got.collect()) == Counter(want)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in docs.collect()}
    tokens = Counter()
    for r in got.collect():
        tokens[r.source] += r.n_tokens
    longest = 40_000
    assert all(0 <= tokens[s] - budgets[s] < longest for s in budgets)


def test_hot_source_gives_way(spark):
    rows = [(k, "a b c d", "hot") for k in range(900)] + [(1000 + k, "a b c d", f"s{k % 9}") for k in range(450)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    count = Counter(r.source for r in X.mix(df).collect())
    assert count["hot"] == 900 and all(99 <= count[f"s{k}"] <= 101 for k in range(9))
    with pytest.raises(ValueError):
        X.mix(df, budget=100_000.0)


def test_blocks_have_the_same_mix(spark):
    rows = [(k, "a b c d", "x" if k % 4 else "y") for k in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    per = Counter((r.block, r.source) for r in X.mix(df, max_repetition=1.0, block_tokens=1600).collect())
    assert all(abs(per[b, "x"] - 300) <= 2 and abs(per[b, "y"] - 100) <= 2 for b in range(10))


def test_order_without_positions(edge, none):
    got = X.mix(edge, positions=False, block_tokens=500)
    assert Counter((r.doc_id, r.copy, r.block) for r in got.collect()) == Counter((r.doc_id, r.copy, r.block) for r in X.mix(edge, block_tokens=500).collect())
    for part in got.rdd.glom().collect():
        blocks = [r.block for r in part]
        assert blocks == sorted(blocks)
    assert X.mix(none).count() == 0
