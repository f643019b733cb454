from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm.shard import default_tree, shard_of, with_shards

from .test_mix import spark_hash


def brute(key, tree):
    leaves = tree
    for level, name in enumerate(("region", "rack", "shard")):
        weight = defaultdict(float)
        for leaf in leaves:
            weight[leaf[level]] += leaf[3]

        def draw(child, weight=weight, name=name):
            seed = 42
            for v in (key, name):
                if v is not None:
                    seed = spark_hash_on(seed, v)
            seed = spark_hash_on(seed, child, True)
            return -math.log(((seed >> 12) + 0.5) / (1 << 52)) / weight[child]

        best = min(weight, key=draw)
        leaves = [x for x in leaves if x[level] == best]
    return leaves[0][2]


def spark_hash_on(seed, value, small=False):
    import xxhash

    if small:  # a 32-bit integer has a hash of its own
        return int_hash(value, seed)
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True) if isinstance(value, int) else value.encode(), seed)


def int_hash(value, seed):
    import xxhash

    return xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed)


@pytest.mark.parametrize("name", ["edge", "docs"])
def test_contract(request, name):
    df = request.getfixturevalue(name)
    got = with_shards(df).collect()
    assert len(got) == df.count()
    slots = defaultdict(list)
    for r in got:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.shard == brute(r.doc_id, default_tree(24)) and r.grown_shard == brute(r.doc_id, default_tree(25))
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def keys(spark, n=20_000):
    return spark.range(n)


def test_balance_and_growth(spark):
    df = keys(spark).select(shard_of(F.col("id"), default_tree(24)).alias("a"), shard_of(F.col("id"), default_tree(25)).alias("b"), shard_of(F.col("id"), default_tree(26)).alias("c"))
    rows = df.collect()
    count = Counter(r.a for r in rows)
    assert len(count) == 24 and all(abs(n - 833) < 150 for n in count.values())
    assert {r.b for r in rows if r.a != r.b} == {24} and {r.c for r in rows if r.b != r.c} == {25}
    assert abs(sum(r.a != r.b for r in rows) - 800) < 150


def test_weights_move_rows_only_in_their_subtree(spark):
    tree = default_tree(24)
    heavier = [(a, b, c, 3.0 if c == 5 else w) for a, b, c, w in tree]
    rows = keys(spark).select(shard_of(F.col("id"), tree).alias("a"), shard_of(F.col("id"), heavier).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    # Regions and racks whose weights stay keep their rows, or give them up to the branch that grew.
    assert moved and all(b < 8 for _, b in moved)
    assert all(b == 5 for a, b in moved if a // 4 == 1)
    count = Counter(r.b for r in rows)
    assert abs(count[5] / 20_000 - 3 / 26) < 0.01
    with pytest.raises(ValueError):
        shard_of(F.lit(1), [(0, 0, 0, 0.0)])


def test_empty(none):
    assert with_shards(none).count() == 0


def test_growth_from_few_shards_takes_rows_only_into_the_new_one(spark):
    from quayside.llm.shard import with_shards

    keys = spark.range(3000).selectExpr("id doc_id", "'x' text")
    for shards, base in ((1, None), (5, None), (10, None), (20, None), (7, 5)):
        rows = with_shards(keys, shards=shards, base_shards=base).collect()
        moved = [r for r in rows if r.grown_shard != r.shard]
        assert {r.grown_shard for r in moved} == {shards} and {r.shard for r in rows} == set(range(shards))
        assert 0.5 < len(moved) / (3000 / (shards + 1)) < 1.5
    six = {r.doc_id: r.grown_shard for r in with_shards(keys, shards=5).collect()}
    assert six == {r.doc_id: r.shard for r in with_shards(keys, shards=6, base_shards=5).collect()}
