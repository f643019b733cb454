from __future__ import annotations

import hashlib
import re

import pytest

from quayside.llm.decontaminate import find_contamination, remove_contamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())  # bytes.lower() changes A-Z only


def brute(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        if not n:
            continue
        for k in range(len(w) - n + 1):
            for p in range(len(own) - n + 1):
                if own[p : p + n] == w[k : k + n]:
                    hit |= set(range(p, p + n))
                    found.add(item)
    named = sorted(str(i) for i in found if i is not None)
    sha = hashlib.sha256(",".join(named).encode()).hexdigest()
    return len(own), len(hit), len(named), sha, bool(hit) and 20 * len(hit) >= len(own)


@pytest.fixture(scope="module")
def cases(spark):
    passage = "Alpha beta, gamma DELTA epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    items = [(9, passage), (10, "rareÉ Pair"), (2, "rareÉ pair"), (None, "lonely word"), (5, None), (6, ""), (7, "..."), (9, "solo")]
    fill = " ".join(f"w{k}" for k in range(300))
    texts = [
        None, "", "...", passage, fill + " " + passage.lower() + " tail", "x alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu y",
        fill + " alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "a rareÉ-PAIR b", "a rareé pair b", "lonely word",
        "solo", "solos", (passage + "\n") * 3, "alpha-beta_gamma,delta;epsilon zeta eta theta iota kappa lambda mu nu xi",
    ]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(3, passage, "clash"), (None, passage, "clash")]
    return rows, items, spark.createDataFrame(rows, "doc_id long, text string, N_HIT string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [2_000_000, 20])
def test_matches_brute_force(cases, limit):
    rows, items, docs, benchmark = cases
    got = find_contamination(docs, benchmark, broadcast_windows=limit)
    assert [c.lower() for c in got.columns].count("n_hit") == 1
    found = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()]
    want = [(d, *brute(t, items)) for d, t, _ in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_removal(cases):
    rows, items, docs, benchmark = cases
    kept = remove_contamination(docs, benchmark)
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == sorted(
        ((d, t) for d, t, _ in rows if d is not None and not brute(t, items)[4]), key=lambda x: x[0]
    )
    cut = {r.doc_id: r.text for r in remove_contamination(docs, benchmark, remove="spans").collect()}
    assert cut[0] is None and cut[7] == "a  b" and cut[8] == "a rareé pair b" and cut[10] == ""
    assert not any(brute(t, items)[1] for t in cut.values())
    with pytest.raises(ValueError):
        remove_contamination(docs, benchmark, remove="lines")


def test_empty_tables(spark, cases, none):
    _, items, docs, benchmark = cases
    assert find_contamination(none, benchmark).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert remove_contamination(docs, nothing).count() == docs.count()
    clean = find_contamination(docs, nothing)
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.where("doc_id = 3").first().n_words == 16


def test_edge_rows(edge, spark):
    benchmark = spark.createDataFrame([(1, "zzz")], "item_id long, text string")
    got = find_contamination(edge, benchmark)
    assert got.count() == edge.count() and got.where("n_hit > 0").count() == 20
