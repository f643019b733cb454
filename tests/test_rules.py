"""Truth tables of the conversion rules, expected values worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.rules import apply_rule, rule_family
from quayside.functions.vendor import DECIMAL_TYPES, base_type, coerce

DEC = T.DecimalType(24, 4)
RULES = (
    "date date0 date1 date2 date3 date4 date5 date6 date7 date8 numeric timestamp bigint "
    "datum datum1 datum2 datum3 datum4 binary bit other"
).split()

TRUTH = {
    "date1": {
        "12/31/2023": "2023-12-31", "12.31.2023 10:00": "2023-12-31", "1/2/2023": "1/2/2023",
        "abc": "abc", "": "",
    },
    "date2": {
        "2024-01-02 03:04:05.0": "to_date('2024-01-02 03:04:05','yyyy-mm-dd hh24:mi:ss')",
        "-5": "to_date('','yyyy-mm-dd hh24:mi:ss')", "1": "1", "": "",
    },
    "date3": {"2024-01-02 03:04:05.0": "2024-01-02 03:04:05", "abc": "abc"},
    "date4": {"2024-01-02 03:04:05.0": "2024-01-02 03:04:05.0", "abc": "abc"},
    "date5": {
        "19000": "2022-01-08", "-5": "1969-12-27", "+7": "1970-01-08", "abc": "abc", " 7 ": " 7 ",
        "7\n": "7\n", "1700000000": "1700000000", "9223372036854775808": "9223372036854775808",
        "-719162": "0001-01-01", "2932896": "9999-12-31", "2932897": "2932897",
    },
    "date6": {
        "1700000000123": "2023-11-14 22:13:20", "1700000000": "2023-11-14 22:13:20",
        "170000000": "170000000", "abc": "abc", "-000000001": "1969-12-31 23:59:59",
        "17000000 0": "17000000 0",
    },
    "date7": {"O'Br": "OBr", "a\0b''": "ab", "": ""},
    "date8": {"Y": "1", "n": "0", "ANY": "0", "yes": "1", "1": "1", "null": "0", "": ""},
    "date0": {"abc": "abc", "null": "null"},
    "other": {"abc": "abc", "null": "null"},
    "numeric": {
        " 7 ": Decimal(7), "1e3": Decimal(1000), "1.5": Decimal("1.5"), "NaN": None, "abc": None,
        "null": None, "": None, "9223372036854775808": Decimal("9223372036854776000"),
        "1e30": None, "Infinity": None,
    },
    "timestamp": {
        "2024-01-02 03:04:05.0": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.999": datetime(2024, 1, 2, 3, 4, 5),
        "2024-1-2 03:04:05.25": datetime(2024, 1, 2, 3, 4, 5, 200000),
        "2024-01-02T03:04:05": None, "2024-01-02 03:04": None, "2024-1-5 3:4:5": None,
        "2024-02-30 00:00:00": datetime(2024, 3, 1), "2024-02-32 00:00:00": None,
        "2024-01-02 25:61:61": datetime(2024, 1, 3, 2, 2, 1),
        "2024-01-02 03:04:+5": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:-5": datetime(2024, 1, 2, 3, 3, 55),
        "2024-01-02 +3:04:05": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 -3:04:05": datetime(2024, 1, 1, 21, 4, 5),
        "2024-01-31 23:59:59": datetime(2024, 1, 31, 23, 59, 59),
        "2024-01-02 03:04:5Z": None, "2024-01-02 03:04: 5": None, "2024-01-02 03:04:.5": None,
        "2024-01-1x 03:04:05": None, "2024-1:-02 03:04:05": None, " 024-01-02 03:04:05": None,
        "+024-01-02 03:04:05": None, "2024-01- 2 03:04:05": None, "2024-01-02 03:0x:05": None,
        "2024-13-02 03:04:05": None, "2024-01-02 03:04:xx": None, "abc": None,
    },
    "bigint": {
        "+7": 7, "-5": -5, "9223372036854775807": 2**63 - 1, "1.0": None, " 7 ": None, "7\n": None,
        "9223372036854775808": None, "": None, "1e3": None,
    },
    "datum1": {
        "2024-1-5": date(2024, 1, 5), "2024-02-30": date(2024, 3, 1), "2023-02-29": date(2023, 3, 1),
        "2024-04-31": date(2024, 5, 1), "2024-02-32": None, "2024-00-10": None, "19000": None,
        "2024": None, "2024-01-02 00:00:00": None, "2024-01-02\n": None, "24-01-02": None,
        "2024-01-1 ": None, "2024-01- 1": None, " 024-01-01": None, "+024-01-01": None,
        "2024-01-1x": None, "2024-1:-01": None, "2024-12-31": date(2024, 12, 31),
        "2024-01-012": None, "2024-1-5T": None, "2024-01-5T": None,
    },
    "datum2": {
        "19000": date(2022, 1, 8), "-5": date(1969, 12, 27), "abc": None, "1700000000": None,
    },
    "datum3": {"2024-01-02 03:04:05": None},
    "datum4": {
        "1700000000123": datetime(2023, 11, 14, 22, 13, 20), "170000000": None, "abc": None,
    },
    "binary": {
        "258": bytes.fromhex("00000102"), "-5": bytes.fromhex("FFFFFFFB"),
        "4294967298": bytes.fromhex("00000002"), "abc": None, "": None,
    },
    "bit": {
        "Y": 1, "n": 0, "ANY": 0, "yes": 1, "1": 1, "127": 127, "-128": -128, "128": None,
        "300": None, "abc": None, "null": 0, "": None, "99999999999999999999": None,
    },
}


def outcomes(spark, values, dtype, build):
    rows = [(i, v) for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)])
    outcome = build(F.col("v"))
    ok = F.lit(True) if outcome.ok is None else outcome.ok
    df = spark.createDataFrame(rows, schema).select("i", outcome.value.alias("x"), ok.alias("ok"))
    return [(r.x if not isinstance(r.x, bytearray) else bytes(r.x), r.ok) for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("rule", sorted(TRUTH))
def test_truth_table(spark, rule):
    texts = [*TRUTH[rule], None]
    expected = [*TRUTH[rule].values(), None]
    got = outcomes(spark, texts, T.StringType(), lambda c: apply_rule(rule, c, T.StringType(), DEC))
    assert dict(zip(texts, (x for x, _ in got))) == dict(zip(texts, expected))
    assert got[-1] == (None, True)
    if rule_family(rule) not in ("date", "text"):
        # a typed rule fits exactly where it has a value
        assert [ok for _, ok in got[:-1]] == [x is not None for x in expected[:-1]]


def test_text_rules_report_misfits(spark):
    cases = {"date1": "1/2/2023", "date2": "1", "date3": "abc", "date4": "abc", "date5": "x", "date6": "1"}
    for rule, text in cases.items():
        [(value, ok)] = outcomes(spark, [text], T.StringType(), lambda c: apply_rule(rule, c, T.StringType()))
        assert (value, ok) == (text, False), rule


def test_families():
    assert rule_family("timestampdate") == "date"
    assert rule_family("datum9") == "datum"
    assert rule_family("orabit") == "bit"
    assert rule_family("DATE1") == "text"


def test_unnumbered_datum_is_a_plain_date(spark):
    got = outcomes(spark, ["2024-1-5"], T.StringType(), lambda c: apply_rule("datumX", c, T.StringType()))
    assert got == [(date(2024, 1, 5), True)]


AT = datetime(2024, 3, 31, 10, 30, 5, 250000)
DECODED = {
    "date0": "2024-03-31 10:30:05.25", "date1": "2024-03-31", "date2":
    "to_date('2024-03-31 10:30:05','yyyy-mm-dd hh24:mi:ss')", "date3": "2024-03-31 10:30:05",
    "date4": "2024-03-31 10:30:05", "date5": "2024-03-31", "date6": "2024-03-31 10:30:05",
    "timestamp": AT, "datum1": date(2024, 3, 31), "datum2": date(2024, 3, 31), "datum3": AT,
    "datum4": AT, "bigint": 1711881005250000,
}


@pytest.mark.parametrize("dtype", [T.TimestampNTZType(), T.TimestampType()])
@pytest.mark.parametrize("rule", sorted(DECODED))
def test_decoded_timestamps(spark, rule, dtype):
    df = spark.sql(f"SELECT CAST('{AT}' AS {dtype.simpleString()}) v")
    value = df.select(apply_rule(rule, F.col("v"), dtype).value).first()[0]
    assert value == DECODED[rule]


def test_decoded_dates(spark):
    expected = {
        "date0": "2024-03-31", "date1": "2024-03-31", "date3": "2024-03-31",
        "date4": "2024-03-31 00:00:00", "date5": "2024-03-31", "datum1": date(2024, 3, 31),
        "datum4": datetime(2024, 3, 31), "bigint": 19813, "numeric": Decimal(19813),
    }
    df = spark.sql("SELECT DATE'2024-03-31' v")
    for rule, value in expected.items():
        assert df.select(apply_rule(rule, F.col("v"), T.DateType()).value).first()[0] == value, rule


def test_noon_and_dst(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' v")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ntz = T.TimestampNTZType()
        rule = lambda name, noon: df.select(
            apply_rule(name, F.col("v"), ntz, int96_noon=noon).value
        ).first()[0]
        assert rule("date4", False) == "2024-03-10 02:30:00"
        assert rule("date4", True) == "2024-03-10 14:30:00"
        assert rule("datum3", True) == datetime(2024, 3, 10, 14, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_seconds_follow_the_session_zone(spark):
    df = spark.sql("SELECT '1700000000' v")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Almaty")
    try:
        text = df.select(apply_rule("date6", F.col("v"), T.StringType()).value).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == "2023-11-15 04:13:20"


def test_typed_numbers(spark):
    row = spark.sql(
        "SELECT 9007199254740993L n, CAST('12345678901234567890.1234' AS DECIMAL(24,4)) d, 0.1F f, 19000 i, X'59' b"
    )
    pick = lambda rule, c: row.select(apply_rule(rule, F.col(c), row.schema[c].dataType, DEC).value).first()[0]
    assert pick("numeric", "n") == Decimal("9007199254740993")
    assert pick("numeric", "d") == Decimal("12345678901234567890.1234")
    assert pick("numeric", "f") == Decimal("0.1")
    assert pick("datum2", "i") == date(2022, 1, 8)
    assert pick("date5", "i") == "2022-01-08"
    assert pick("bit", "b") == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("0123456789-+:./ TyYnNe'\0\n\t"), max_size=24), min_size=50, max_size=50))
def test_rules_never_raise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    columns = []
    for i, rule in enumerate(RULES):
        outcome = apply_rule(rule, F.col("v"), T.StringType())
        columns += [outcome.value.alias(f"x{i}")]
        columns += [] if outcome.ok is None else [outcome.ok.alias(f"ok{i}")]
    for row in df.select(columns).collect():
        assert all(row[c] is not None for c in row.asDict() if c.startswith("ok"))


VENDOR = {
    "TINYINT": {"1": 1, "300": None, None: None, " 1": None},
    "bit": {"-128": -128, "Y": None},
    "INT8": {None: 0, " 7 ": 7, "1.0": 0, "abc": 0},
    "numeric(10,2)": {"1e3": Decimal(1000), "abc": None, None: None},
    "VARCHAR(10)": {"null": "null", None: None},
    "FixedString(16)": {"abc": "abc"},
    "DateTime": {"2024-01-02 03:04:05.7": datetime(2024, 1, 2, 3, 4, 5), "2024-01-02": None},
    "timestamp": {"2024-01-02T03:04:05": None},
    "INT64": {"12": "12"},
    "DATE": {"2024-01-02": "2024-01-02"},
}


@pytest.mark.parametrize("vendor", sorted(VENDOR))
def test_vendor_types(spark, vendor):
    got = outcomes(spark, [*VENDOR[vendor]], T.StringType(), lambda c: coerce(vendor, c, T.StringType(), DEC))
    assert [x for x, _ in got] == [*VENDOR[vendor].values()]


def test_int8_reports_bad_text(spark):
    got = outcomes(spark, ["abc", None, "1"], T.StringType(), lambda c: coerce("INT8", c, T.StringType()))
    assert got == [(0, False), (0, True), (1, True)]


def test_vendor_types_of_typed_columns(spark):
    row = spark.sql("SELECT 7 i, DATE'1970-01-03' d, 1.5D x, CAST(NULL AS INT) n, true b")
    pick = lambda t, c: row.select(coerce(t, F.col(c), row.schema[c].dataType).value).first()[0]
    assert [pick("INT8", c) for c in "idxnb"] == [7, 0, 0, 0, 1]
    assert [pick("TINYINT", c) for c in "idxnb"] == [7, None, None, None, 1]
    assert [pick("NUMERIC", c) for c in "idxnb"] == [7, None, Decimal("1.5"), None, Decimal(1)]
    assert pick("TIMESTAMP", "d") == datetime(1970, 1, 3)
    assert pick("DATE", "d") == "1970-01-03"


def test_vendor_names():
    assert base_type("FixedString(16)") == "FIXEDSTRING"
    assert len(DECIMAL_TYPES) == 19


def test_floating_targets_keep_the_double(spark):
    texts = ["1e-15", "1e30", "0.123456789012345", "n/a", "NaN", "Infinity", "1e400", None, " 2.5 ", "3d"]
    got = outcomes(spark, texts, T.StringType(), lambda c: apply_rule("numeric", c, T.StringType(), T.DoubleType()))
    assert [x for x, _ in got] == [1e-15, 1e30, 0.123456789012345, None, None, None, None, None, 2.5, 3.0]
    assert [ok for _, ok in got] == [True, True, True, False, False, False, False, True, True, True]
    got = outcomes(spark, ["1e30", "1e39", "0.5"], T.StringType(), lambda c: coerce("FLOAT4", c, T.StringType(), T.FloatType()))
    assert [x and round(x / 1e30, 3) for x, _ in got] == [1.0, None, 0.0]
