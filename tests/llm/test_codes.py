"""Vector codes against plain loops in Python's integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from quayside.llm.codes import build_trie, codebooks_sha256, compress, encode, fit_codebooks, nearest
from quayside.llm.store import table

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def whole(x):
    return int(x) * 256 if abs(x) >= 2.0**52 else math.floor(x * 256)


def brute(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error) sorted, and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    dim = len(kept[0][1])
    width = dim // parts
    cut = {i: [tuple(map(whole, r[1][p * width : (p + 1) * width])) for p in range(parts)] for i, r in enumerate(kept) if len(r[1]) == dim}
    books = [[v[p] for v in list(cut.values())[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for v in cut.values():
                members.setdefault(near(v[p], book)[1], []).append(v[p])
            books[p] = [tuple(sum(c) // len(members[i]) for c in zip(*members[i])) if i in members else e for i, e in enumerate(book)]
    out, labels = [], {}
    for i, (key, _, label, *_) in enumerate(kept):
        code = error = None
        if i in cut:
            found = [near(part, book) for part, book in zip(cut[i], books)]
            code, error = "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)
        out.append((key, code, error if error is None or error < 1 << 63 else None, label))
    for _, _, error, label in out:
        labels[label] = (labels.get(label) or 0) + error if error is not None else labels.get(label)
    labels = {k: v if v is None or v < 1 << 63 else None for k, v in labels.items()}
    return sorted(((k, c, e, labels[g]) for k, c, e, g in out), key=repr), books


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error").collect()), key=repr)


def check(spark, rows, parts=4, entries=5, rounds=2):
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    found = compress(docs, parts=parts, entries=entries, rounds=rounds, carry=["vec_id", "code"])
    expected, books = brute(rows, parts, entries, rounds)
    assert got(found) == expected
    sums = {r.codebooks_sha256 for r in found.collect()}
    text = ",".join(str(c) for b in books for e in b for c in e)
    assert sums == ({hashlib.sha256(text.encode()).hexdigest()} if expected else set())


def some_rows(n, dim=8, levels=5):
    rnd = random.Random(n)
    return [(i, [rnd.randrange(-levels, levels) / 256 + 0.001 for _ in range(dim)], rnd.choice([None, 1, 2])) for i in range(n)]


def test_random(spark):
    check(spark, some_rows(300))
    check(spark, some_rows(40, levels=400), entries=64)


def test_defined_cases(spark):
    rows = some_rows(30)
    rows += [(31, None, 1), (32, [1.0] * 7 + [None], 1), (33, [math.nan] * 8, 1), (34, [math.inf] + [0.0] * 7, 2)]
    rows += [(35, [0.5] * 3, 1), (36, [], None), (None, [0.25] * 8, 7), (3, [9.0] * 8, 1), (3, rows[3][1], 1)]
    check(spark, rows)


def test_huge_components(spark):
    check(spark, some_rows(20) + [(50, [1e17, -3e5] * 4, 3), (51, [2.0**40] * 8, 3), (52, [-1e300] + [0.0] * 7, 4)])


def test_empty_and_few(spark):
    check(spark, [])
    check(spark, [(1, None, 1)])
    check(spark, some_rows(3), entries=64)
    with pytest.raises(ValueError):
        fit_codebooks(spark.createDataFrame([(1, [1.0] * 7, 1, "")], SCHEMA), parts=4)


def test_trie_shares_prefixes():
    rows = np.array([[1, 2, 3], [1, 2, 4], [0, 5, 5], [1, 2, 3], [0, 6, 5]])
    trie = build_trie(rows)
    assert [v.tolist() for v in trie.values] == [[0, 1], [5, 6, 2], [5, 5, 3, 4]]
    assert trie.weights.tolist() == [1, 1, 2, 1] and trie.leaf_of_row.tolist() == [2, 3, 0, 2, 1]
    rnd = np.random.default_rng(1)
    rows, entries = rnd.integers(-9, 9, (500, 4)), rnd.integers(-9, 9, (7, 4))
    trie = build_trie(rows)
    plain = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for nodes in (1, 7, 2048):
        index, distance = nearest(trie, entries, nodes)
        assert (index[trie.leaf_of_row] == plain.argmin(axis=1)).all()
        assert (distance[trie.leaf_of_row] == plain.min(axis=1)).all()


def test_codes_restore_vectors(spark, sf):
    """Entries named by a code are as far from the vector as its error says."""
    vectors = table(spark, sf, "embeddings")
    books = fit_codebooks(vectors, rounds=1)
    assert len(books) == 16 and {len(b) for b in books} == {64} and len(codebooks_sha256(books)) == 64
    for r in encode(vectors, books).join(vectors.select("vec_id", "embedding"), "vec_id").collect():
        near = [c for p, book in enumerate(books) for c in book[int(r.code[2 * p : 2 * p + 2], 16)]]
        assert sum((whole(x) - c) ** 2 for x, c in zip(r.embedding, near)) == r.error
