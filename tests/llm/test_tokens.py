from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from quayside.llm import counts as C
from quayside.llm.pack import Capacities, best_fit, pack
from quayside.llm.tokens import Vocabulary, read_vocabulary

V = Vocabulary(read_vocabulary()["ranks"])


def ids(text):
    return V.encoding.encode_ordinary(text or "")


def test_remembered_pieces_change_nothing(edge, docs):
    odd = [" a  b \n c\t d ", "é  x  y", " lead", "trail ", "a  b", "a  b", "\n a", "it's  we'll", "x \x1c y"]
    for text in odd + [r.text for r in edge.collect()] + [r.text for r in docs.limit(60).collect()]:
        assert np.frombuffer(V.encode(text), V.dtype).tolist() == ids(text)


@pytest.mark.parametrize(("row", "block"), [(2048, 1 << 22), (64, 2000)])
def test_packing_round_trip(edge, row, block):
    out = pack(edge, row_tokens=row, block_tokens=block).collect()
    assert len({r.row_id for r in out}) == len(out)
    found = defaultdict(list)
    for r in out:
        matrix, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(matrix) == len(places) == row and r.cu_seqlens[-1] == r.n_tokens <= row and len(r.doc_ids) == r.n_segments
        assert (matrix[r.n_tokens :] == V.end).all()
        for k, (doc, offset) in enumerate(zip(r.doc_ids, r.offsets, strict=True)):
            a, b = r.cu_seqlens[k : k + 2]
            assert places[a:b].tolist() == list(range(b - a))
            found[doc].append((offset, matrix[a:b].tolist()))
    want = Counter()
    for r in edge.collect():
        want[r.doc_id] += len(ids(r.text)) + 1
    assert {d: sum(len(x) for _, x in s) for d, s in found.items()} == want
    single = Counter(r.doc_id for r in edge.collect())
    for r in edge.collect():
        if single[r.doc_id] == 1:
            assert sum((x for _, x in sorted(found[r.doc_id])), []) == [*ids(r.text), V.end]


def test_best_fit_decreasing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 400)
    rows, free = [], []
    for k in np.argsort(-lengths, kind="stable").tolist():
        fits = [(f, i) for i, f in enumerate(free) if f >= lengths[k]]
        if fits:
            least = min(f for f, _ in fits)
            row = [i for f, i in fits if f == least]
            free[row[0]] -= lengths[k]
            rows.append(least)
        else:
            free.append(100 - lengths[k])
            rows.append(100)
    got = best_fit(lengths, 100)
    assert sorted(k for r in got for k in r) == list(range(400))
    assert len(got) == len(free) and sorted(100 - sum(lengths[r]) for r in got) == sorted(free)
    tree = Capacities(10)
    assert tree.least(0) == -1
    tree.add(7, 1)
    assert (tree.least(3), tree.least(7), tree.least(8)) == (7, 7, -1)


@pytest.mark.parametrize("block", [1 << 19, 50])
def test_counts_by_separator_scan(edge, block):
    got = C.count_document_tokens(edge, block_tokens=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r.doc_id, len(ids(r.text))) for r in edge.collect())
    by_file = defaultdict(list)
    for r in got:
        by_file[r.file].append((r.ordinal, r.start, r.n_tokens))
    for rows in by_file.values():
        at = 0
        for k, (ordinal, start, n) in enumerate(sorted(rows)):
            assert (ordinal, start) == (k, at)
            at += n + 1


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_token_files(spark, tmp_path, block):
    files = {"a": [5, 6, 9, 9, 1, 2, 3, 9, 4], "b": [9], "c": [], "d": [1, 2, 9], "e": [7] * 11}
    for name, own in files.items():
        np.array(own, "<u2").tofile(tmp_path / name)
    got = {(r.file[-1], r.ordinal, r.start, r.n_tokens, r.ended) for r in C.count_file_tokens(spark, str(tmp_path), end=9, block_tokens=block).collect()}
    assert got == {("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 3, True), ("a", 3, 8, 1, False), ("b", 0, 0, 0, True), ("d", 0, 0, 2, True), ("e", 0, 0, 11, False)}


def test_broken_file_raises(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole ids"):
        C.count_file_tokens(spark, str(tmp_path), end=9)


def test_empty(none):
    assert pack(none).count() == 0 and C.count_document_tokens(none).count() == 0
