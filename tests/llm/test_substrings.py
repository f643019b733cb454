from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from quayside.llm import substrings as S


def brute(texts):
    counts = Counter()
    for b in texts:
        counts.update(b[k : k + 400] for k in range(len(b) - 399))
    out = []
    for b in texts:
        keep, end = bytearray(b"\1" * len(b)), 0
        for k in range(len(b) - 399):
            if counts[b[k : k + 400]] > 1:
                low = max(k, end)
                keep[low : k + 400] = bytes(k + 400 - low)
                end = k + 400
        spans = sum(1 for k in range(len(b)) if not keep[k] and (not k or keep[k - 1]))
        left = bytes(x for x, k in zip(b, keep) if k)
        out.append((len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(200)]
    base = [" ".join(rnd.choice(words) for _ in range(300)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "x" * 399), (3, "y" * 400), (4, "z" * 401), (5, "ab" * 500), (6, "y" * 400), (None, base[0]), (7, base[0])]
    for k in range(8, 60):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            own = rnd.choice(base)
            at = rnd.randrange(len(own) - 800)
            parts += [own[at : at + rnd.randint(380, 700)], " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))]
        rows.append((k, " ".join(parts)))
    return rows + rows[20:22]


@pytest.mark.parametrize(("bucket", "broadcast"), [(4096, 2_000_000), (2, 2_000_000), (4096, 0), (2, 0)])
def test_matches_brute_force(spark, rows, monkeypatch, bucket, broadcast):
    """Also where buckets are dealt out by string, and where hashes and contexts are too many to be broadcast."""
    monkeypatch.setattr(S, "BUCKET", bucket)
    monkeypatch.setattr(S, "BROADCAST_HASHES", broadcast)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, N_BYTES string").repartition(4)
    got = S.remove_repeats(df)
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect())
    want = brute([(t or "").encode() for _, t in rows])
    assert found == Counter((d, *w) for (d, _), w in zip(rows, want))


def test_chunk_borders(spark, monkeypatch):
    monkeypatch.setattr(S, "_CHUNK", 500)
    rnd = random.Random(5)
    shared = "".join(rnd.choice("abcdefgh") for _ in range(900))
    texts = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 700))) + shared[rnd.randint(0, 300) :] + "".join(rnd.choice("xyz") for _ in range(200)) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df).collect())
    assert found == [(k, *w) for k, w in enumerate(brute([t.encode() for t in texts]))]


def test_edge_rows(edge, none):
    got = S.remove_repeats(edge, carry=["doc_id", "text"]).collect()
    want = brute([(r.text or "").encode() for r in got])
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want
    assert all(sum(x.last - x.first for x in r.removed) == r.n_removed for r in got)
    assert S.remove_repeats(none).count() == 0
