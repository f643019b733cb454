"""Beyond the bounds of what is broadcast, joins shuffle and results stay the same."""

from __future__ import annotations

import pytest

from quayside.llm import licenses, minhash, queries, store


@pytest.mark.parametrize("name", ["op3_mix", "op4_quality", "op6_minhash", "op7_licenses", "op10_shard", "op12_phrases", "op13_codes"])
def test_nothing_small_enough(spark, sf, monkeypatch, name):
    def rows():
        df = queries.QUERIES[name](spark, sf)
        return sorted(map(str, df.select(sorted(df.columns)).collect()))

    want = rows()
    monkeypatch.setattr(store, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(minhash, "BROADCAST_TEXTS", -1)
    assert rows() == want and want
