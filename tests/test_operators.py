"""Alignment, conversion, rejects, bulk text, profiling."""

from __future__ import annotations

import glob
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import (
    UnsupportedColumn,
    align,
    as_text,
    coerce_to_target,
    convert,
    shift_date,
    split_bulk,
    split_rejects,
    suggest_rules,
    write_bulk_text,
)
from quayside.operators.rejects import FAILED


@pytest.fixture(scope="module")
def src(spark):
    return spark.createDataFrame(
        [("a", 1, "x", "1.5"), ("null", 2, None, "bad"), (None, 3, "z", None)],
        "name string, Id bigint, extra string, amt string",
    )


TARGET = T.StructType(
    [
        T.StructField("AMT", T.DecimalType(20, 4)),
        T.StructField("ID", T.LongType()),
        T.StructField("load_dt", T.DateType()),
        T.StructField("NAME", T.StringType()),
    ]
)


def test_align_orders_and_names(src):
    assert align(src, TARGET).columns == ["NAME", "ID", "AMT"]
    assert align(src, TARGET, "target").columns == ["AMT", "ID", "NAME"]
    assert align(src, ["nAME", "nothing"]).columns == ["nAME"]
    for target, order in ((["other"], "source"), (TARGET, "backwards")):
        with pytest.raises(ValueError):
            align(src, target, order)


def test_align_refuses_ambiguous_names(spark, src):
    with pytest.raises(ValueError, match="differ only in case"):
        align(src, ["name", "NAME"])


def test_names_with_dots(spark):
    df = spark.createDataFrame([("1", "x")], "`a.b` string, c string")
    assert convert(align(df, ["A.B", "c"]), {"a.b": "bigint"}).first()[0] == 1


def test_nested_columns_are_refused(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert align(vectors, ["vec_id", "label"]).columns == ["vec_id", "label"]
    for action in (
        lambda: align(vectors, ["embedding"]),
        lambda: convert(vectors, {}),
        lambda: split_bulk(vectors),
        lambda: as_text(vectors),
        lambda: coerce_to_target(vectors, {c: "INT8" for c in vectors.columns}),
    ):
        with pytest.raises(UnsupportedColumn, match="embedding"):
            action()


def test_convert(src):
    rows = convert(src, {"AMT": "numeric"}, TARGET).orderBy("Id").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 1, "x", Decimal("1.5")), (None, 2, None, None), (None, 3, "z", None),
    ]
    assert convert(src, "amt=numeric", TARGET).schema["amt"].dataType == T.DecimalType(20, 4)


def test_mapped_null_text_takes_its_rule(spark):
    df = spark.createDataFrame([("null", "null", "null")], "a string, b string, c string")
    assert tuple(convert(df, "a=bit,b=date8").first()) == (0, "0", None)


def test_unknown_mapped_columns_warn(src):
    with pytest.warns(UserWarning, match="no such column nope"):
        convert(src, "nope=bit")


def test_good_and_rejects_cover_the_input(spark, sf):
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "*",
        F.concat("l_quantity", F.when(F.col("l_tax") > 0.05, " kg").otherwise("")).alias("q"),
        F.when(F.col("l_discount") < 0.09, "01/02/2024").alias("d"),
    )
    good, bad = split_rejects(raw, {"q": "numeric", "d": "date1", "l_returnflag": "bigint"})
    assert good.count() + bad.count() == raw.count()
    assert bad.columns == [*raw.columns, FAILED]
    assert bad.where("size(failed_columns) = 0").isEmpty()
    # rejects keep their rows as they were
    assert bad.drop(FAILED).exceptAll(raw).isEmpty()
    failures = {tuple(r[0]) for r in bad.select(FAILED).distinct().collect()}
    assert failures == {("l_returnflag",), ("l_returnflag", "q")}


def test_rejects_of_a_text_rule(spark):
    df = spark.createDataFrame([("12/31/2023",), ("1/2/23",), (None,)], "d string")
    good, bad = split_rejects(df, "d=date1")
    assert {r.d for r in good.collect()} == {"2023-12-31", None}
    assert [tuple(r) for r in bad.collect()] == [("1/2/23", ["d"])]


def test_bulk_file(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "O'Br", "01/02/2024", "null"), (2, "null", None, "7"), (3, "a\tb", None, None)],
        "id int, name string, day string, n string",
    ).coalesce(1)
    lines, bad = split_bulk(df, "day=date1,n=numeric", "by=me,on=?date", date(2024, 3, 31))
    assert [(r.id, r[FAILED]) for r in bad.collect()] == [(3, ["name"])]
    write_bulk_text(lines, str(tmp_path / "out"))
    [part] = glob.glob(str(tmp_path / "out" / "part-*"))
    with open(part, "rb") as f:
        assert f.read() == (
            b"1\tOBr\t2024-01-02\tnull\tme\t2024-03-31\t\r\n2\t\t\t7\tme\t2024-03-31\t\r\n"
        )


@pytest.mark.parametrize("broken", ["a\tb", "a\rb", "a\nb", "a\r\n"])
def test_bulk_rejects_line_breaks(spark, broken):
    lines, bad = split_bulk(spark.createDataFrame([(broken,), ("ok",)], "v string"))
    assert [r.value for r in lines.collect()] == ["ok\t"]
    assert bad.count() == 1


def test_text_and_suggestions(spark):
    df = spark.createDataFrame(
        [("null", "", 1.5, "12/31/2023"), ("NULL", "x", None, "01/02/2023")],
        "a string, b string, c double, d string",
    )
    assert [tuple(r) for r in as_text(df).collect()] == [
        (None, None, "1.5", "12/31/2023"), ("NULL", "x", None, "01/02/2023"),
    ]
    assert as_text(df, empty_as_null=False).first().b == ""
    rules = {r.column_name: r.rule for r in suggest_rules(df).collect()}
    assert rules == {"a": "date0", "b": "date0", "d": "date1"}
    with pytest.raises(ValueError):
        suggest_rules(df.select("c"))


def test_shift_clamps_months(spark):
    df = spark.sql("SELECT explode(array(DATE'2024-01-31', DATE'2023-01-31')) d")
    shifted = df.select(shift_date(F.col("d"), "[+1month]").alias("x")).collect()
    assert {r.x for r in shifted} == {"2024-02-29", "2023-02-28"}
