from __future__ import annotations

from collections import Counter

import corpus_pipeline as P
from quayside.llm.decontaminate import find_contamination

from .test_minhash import brute as classes
from .test_quality import brute as quality
from .test_shard import brute as shard_of_key


def staged(spark, docs, sf, tmp_path):
    out = [docs]
    for name, stage in P.STAGES:
        stage(spark, out[-1], sf).write.parquet(str(tmp_path / name))
        out.append(spark.read.parquet(str(tmp_path / name)))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def check(spark, docs, sf, tmp_path):
    raw, good, single, clean, mixed, sharded = staged(spark, docs, sf, tmp_path)
    for df in (good, single, clean, mixed):
        assert df.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in raw.collect()]
    # Quality: base failures go; without bad hosts nothing else does.
    assert ids(good) == Counter(d for d, t in rows if not quality(t)[5])
    rows = [(r.doc_id, r.text) for r in good.collect()]
    want = Counter(min((rows[k][0] for k in c if rows[k][0] is not None), default=None) for c in classes(rows))
    assert ids(single) == want
    found = {r.doc_id for r in find_contamination(single, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").collect()}
    assert ids(clean) == Counter({d: n for d, n in want.items() if d not in found})
    copies = ids(mixed)
    assert set(copies) == set(ids(clean)) and max(copies.values(), default=1) <= 2
    assert ids(sharded) == copies
    by_shard = Counter()
    for r in sharded.collect():
        by_shard[r.shard] += 1
        assert r.shard == shard_of_key(r.doc_id, P_TREE)
    slots = Counter((r.shard, r.slot) for r in sharded.collect())
    assert max(slots.values(), default=1) == 1 and all(slot < by_shard[s] for s, slot in slots)
    return raw, sharded


from quayside.llm.shard import default_tree  # noqa: E402

P_TREE = default_tree(24)


def test_stages_on_documents(spark, docs, sf, tmp_path):
    _, sharded = check(spark, docs, sf, tmp_path)
    assert sharded.count() > 0
    whole = P.run(spark, sf)
    assert Counter(map(str, whole.select("doc_id", "shard", "slot", "text_crc32").collect())) == Counter(map(str, sharded.select("doc_id", "shard", "slot", "text_crc32").collect()))


def test_stages_on_edge_rows(spark, edge, sf, tmp_path):
    check(spark, edge.drop("Size", "KEPT"), sf, tmp_path)


def test_stages_on_an_empty_table(spark, none, sf, tmp_path):
    *_, sharded = staged(spark, none.drop("Size", "KEPT"), sf, tmp_path)
    assert sharded.count() == 0


def test_slots_follow_the_mix(spark, sf, tmp_path):
    """Blocks and permutations survive into every shard's slots, and copies of a document do not lie side by side."""
    from quayside.llm.mix import mix

    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    P.mixing(spark, docs, sf).write.parquet(str(tmp_path / "mixed"))
    sharded = P.sharding(spark, spark.read.parquet(str(tmp_path / "mixed")), sf)
    # the texts do not move again
    plan = sharded._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(line for line in plan.split("\n") if "Exchange" in line) and "Window [" not in plan.split("Scan parquet")[0]
    shards = {}
    for r in sharded.select("shard", "slot", "doc_id").collect():
        shards.setdefault(r.shard, {})[r.slot] = r.doc_id
    order = {}
    for r in mix(docs, carry=["doc_id"]).orderBy("block", "position").collect():
        order.setdefault(shard_of_key(r.doc_id, P_TREE), []).append(r.doc_id)
    assert {s: [rows[k] for k in range(len(rows))] for s, rows in shards.items()} == order
    copies = sum(n - 1 for n in Counter(d for rows in order.values() for d in rows).values())
    beside = sum(a == b for rows in order.values() for a, b in zip(rows, rows[1:]))
    assert copies > 100 and beside == 0


def test_files_of_several_shards_are_numbered_by_hash(spark, docs, sf, tmp_path):
    docs.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    rows = P.sharding(spark, plain, sf).select("doc_id", "shard", "slot").collect()
    from quayside.llm.shard import with_shards

    assert sorted(rows) == sorted(with_shards(docs).select("doc_id", "shard", "slot").collect())
    assert sorted(rows) == sorted(P.sharding(spark, plain.where("doc_id is not null"), sf).select("doc_id", "shard", "slot").collect())
