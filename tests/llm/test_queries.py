from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from quayside.llm.queries import ORACLE, QUERIES


def test_registered():
    names = entry_points.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) <= set(names) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf, name, folder):
    path = sf.rsplit("/", 1)[0] + "/" + folder
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    got = QUERIES[name](spark, path)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = want.columns
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_whole_table(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name == "op5_html":
        assert df.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
    elif name not in ("op1_pack", "op3_mix"):
        assert df.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    else:
        assert df.count() > 0
