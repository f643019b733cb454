from __future__ import annotations

import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import minhash as M

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORD.findall((text or "").encode().lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(x, y):
    both = x.keys() & y.keys()
    if not both:
        return 0.0
    if max(x.values()) == max(y.values()) == 1:
        return len(both) / len(x.keys() | y.keys())
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in both)


def brute(rows):
    """doc number -> (class members as a set of row numbers)."""
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    sets = [grams(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is not None and rows[j][1] is not None:
                if rows[i][1] == rows[j][1] or jaccard(sets[i], sets[j]) >= 0.8:
                    parent[find(i)] = find(j)
    classes = defaultdict(list)
    for k in range(len(rows)):
        classes[find(k)].append(k)
    return list(classes.values())


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = Counter()
    for members in brute(rows):
        ids = [rows[k][0] for k in members]
        least = min((i for i in ids if i is not None), default=None)
        want.update((i, least, len(ids)) for i in ids)
    got = M.find_classes(df).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    assert sum(r.kept for r in got) == len(brute(rows))


def test_edge_rows(edge):
    check(edge)


def test_documents(docs):
    check(docs)


@pytest.fixture(scope="module")
def chain(spark):
    """Links without a common neighbour: each text replaces some more words of the one before; and a big star."""
    words = [f"w{k}" for k in range(300)]
    rows, doc = [], 0
    for _ in range(8):
        rows.append((doc, " ".join(words)))
        words = [f"{w}x{doc}" if k in (doc * 37 % 300, doc * 61 % 300) else w for k, w in enumerate(words)]
        doc += 1
    for k in range(60):
        own = [f"s{i}" for i in range(200)]
        own[k * 3 % 200] = f"edit{k}"
        own[(k * 7 + 90) % 200] = f"more{k}"
        rows.append((100 + k, " ".join(own)))
    rows += [(500 + k, " ".join(f"p{i}" for i in range(100)) + " " + " ".join(f"u{k}_{i}" for i in range(60))) for k in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_chain_and_star(chain):
    check(chain)


def test_blocks_of_a_bucket(chain, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 4)
    check(chain)


def test_blocks_by_bytes(chain, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 5000)
    check(chain)


def test_bucket_of_weighted_texts(spark):
    """Repeated phrases: the same shingles at other counts, so that only the weighted similarity decides."""
    rows = []
    for k in range(24):
        phrase = " ".join(f"p{i}" for i in range(12))
        rows.append((k, " ".join([phrase] * (1 + k % 6)) + " " + " ".join(f"t{i}" for i in range(60)) + f" own{k % 4}"))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_signature_estimates_probability_jaccard():
    base = [f"w{k}" for k in range(400)]
    other = base[:250] + [f"v{k}" for k in range(100)] + base[:60]
    texts = pa.array([" ".join(base), " ".join(other), "a b c d e f", "", "one"])
    owner, gram, count = M.shingles(texts)
    drawn = M.signatures(owner, gram, count, 5)
    exact = M.similarities(texts[:1], texts[1:2])[0]
    assert exact == pytest.approx(jaccard(grams(texts[0].as_py()), grams(texts[1].as_py())))
    assert abs((drawn[0] == drawn[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / M.REGISTERS)
    assert set(drawn[2]) == set(gram[owner == 2]) and len(set(drawn[4])) == 1


def test_points_of_many_short_texts_are_drawn_by_parts():
    """Memory follows a part of the texts, not their number; the parts do not change a signature."""
    texts = pa.array([None if k % 7 == 0 else " ".join(f"w{k * j % 301}" for j in range(k % 40)) for k in range(2 * M.DRAWN + 9)])
    owner, gram, count = M.shingles(texts)
    drawn = M.signatures(owner, gram, count, len(texts))
    for k in (0, 1, 6, M.DRAWN - 1, M.DRAWN, 2 * M.DRAWN, len(texts) - 1):
        alone = M.signatures(*M.shingles(texts[k : k + 1]), 1)
        assert (alone[0] == drawn[k]).all()

    def peak(n):
        found = M.shingles(pa.array([f"a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(n)]))
        tracemalloc.start()
        M.signatures(*found, n)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most - n * M.REGISTERS * 8  # without the result

    assert peak(1500) < 1.5 * peak(M.DRAWN)


def test_weighted_similarity():
    left, right = "a b c d e " * 6 + "f g h i j k", "a b c d e " * 3 + "f g h i j k q"
    got = M.similarities(pa.array([left, "x", None]), pa.array([right, "", "a"]))
    assert got[0] == pytest.approx(jaccard(grams(left), grams(right))) and got[1] == 0 and got[2] == 0


def test_weighted_sums_are_the_similarity():
    rng = np.random.default_rng(2)
    other = dict(zip(range(40), rng.integers(1, 5, 40).tolist(), strict=True))
    texts = [dict(zip(rng.permutation(60)[:30].tolist(), rng.integers(1, 4, 30).tolist(), strict=True)) for _ in range(5)]
    x = np.array([c for t in texts for c in t.values()], float)
    y = np.array([other.get(d, 0) for t in texts for d in t], float)
    got = M._weighted(x, y, np.array([30] * 5), sum(other.values()))
    assert got == pytest.approx([jaccard(Counter(t), Counter(other)) for t in texts])


def test_keep_one(edge, none):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    kept = M.keep_one(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len(brute(rows))
    assert M.find_classes(none).count() == 0 and M.keep_one(none).count() == 0
