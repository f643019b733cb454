"""Physical plans: what is read, what is shuffled, what leaves generated code."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quayside import LoadSpec, scan_parquet, split_rejects
from quayside.plans.catalogue import ORDERS_TARGET, QUERIES
from quayside.plans.load import transform
from quayside.session import METHOD_LIMIT_CONF, compiled_methods

# queries that group or join files or ledger lines, or return a table they wrote
SHUFFLING = {
    "column_order", "file_stats", "ledger_compacted", "ledger_pending", "load_keys", "rows_by_file", "rule_int96",
    "suggested_rules", "text_ledger",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf, name):
    plan = physical(QUERIES[name](spark, sf))
    for costly in ("Python", "Cartesian", "NestedLoop", "CollectLimit", "BroadcastExchange"):
        assert costly not in plan
    assert ("Exchange" in plan) == (name in SHUFFLING)


def test_only_needed_columns_are_read(spark, sf):
    raw = scan_parquet(spark, f"{sf}/orders.parquet")
    spec = LoadSpec(map_data_fields="o_orderdate=datum1")
    plan = physical(transform(raw, spec, ORDERS_TARGET))
    assert "o_custkey" not in plan and "o_orderpriority" not in plan


def test_user_filters_reach_the_scan(spark, sf):
    raw = scan_parquet(spark, f"{sf}/orders.parquet")
    loaded = transform(raw, LoadSpec(), ORDERS_TARGET).where("o_orderkey > 100")
    assert "GreaterThan(o_orderkey,100)" in physical(loaded)


def test_reject_split_stays_in_generated_code(spark, sf):
    raw = scan_parquet(spark, f"{sf}/part.parquet")
    for df in split_rejects(raw, "p_retailprice=numeric,p_name=bigint,p_type=date1"):
        nodes = re.findall(r"^[ :+-]*(\*?)(?:\(\d+\) )?(?:Project|Filter) ", physical(df), re.M)
        assert nodes and all(star == "*" for star in nodes)


def test_wide_conversions_stay_compilable(spark, sf):
    """Hundreds of converted columns, in methods the JVM compiles; the session keeps its own setting."""
    raw = scan_parquet(spark, f"{sf}/orders.parquet")
    wide = raw.select([F.col("o_orderpriority").alias(f"c{i}") for i in range(200)])
    before = spark.conf.get(METHOD_LIMIT_CONF)
    with compiled_methods(spark):
        assert int(spark.conf.get(METHOD_LIMIT_CONF)) <= 8000
        good, bad = split_rejects(wide, {f"c{i}": "timestamp" for i in range(200)})
        assert (good.count(), bad.count()) == (0, raw.count())
    assert spark.conf.get(METHOD_LIMIT_CONF) == before


def test_split_converts_once(spark, sf):
    raw = scan_parquet(spark, f"{sf}/orders.parquet")
    texts = raw.select(F.col("o_orderpriority").alias("x"))
    good, bad = split_rejects(texts, "x=numeric")
    for df in (good, bad):
        # one projection holds the conversion, where its common parts are evaluated once
        nodes = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "[eE]" in x]
        assert len(nodes) == 1 and "Project" in nodes[0]


def test_table_copies_stay_compilable(spark, sf):
    """The coerced table runs in methods the JVM compiles, in a session of its own."""
    df = QUERIES["coerce_target"](spark, sf)
    assert int(df.sparkSession.conf.get(METHOD_LIMIT_CONF)) <= 8000 < int(spark.conf.get(METHOD_LIMIT_CONF))
    assert df.count() > 0
