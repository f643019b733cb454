"""Parameters: maps, constants, paths, connection settings."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from quayside import JdbcTable, LoadSpec, parse_constants, parse_map, resolve_path, with_constants
from quayside.functions.shift import Shift, parse_shifts
from quayside.plans import run_params
from quayside.tables import split_script

RUN = datetime(2024, 3, 31, 10, 30)


def test_maps():
    assert parse_map("A=date1,b=numeric") == {"A": "date1", "b": "numeric"}
    assert parse_map("") == {}
    assert parse_map("A=x=y,A=z") == {"A": "z"}
    for bad in ("A", "=x", "A=1,B"):
        with pytest.raises(ValueError):
            parse_map(bad)


def test_shift_chains():
    assert parse_shifts("[-1day][+2month]") == [Shift(-1, "day"), Shift(2, "month")]
    for bad in ("[-1year]", "[day]", "[-1day]x", "-1day"):
        with pytest.raises(ValueError):
            parse_shifts(bad)


CONSTANTS = {
    "A=x": "x", "B=?date": "2024-03-31", "C=?date[-1month]": "2024-02-29",
    "D=?date[-1day][+1month]": "2024-04-30", "E=?date[-1hour]": "2024-03-30",
    "F=?date[+5minute]": "2024-03-31", "G=run ?date!": "run 2024-03-31!", "H=a[b": "a[b",
    "I=?date[-1month][+1day]": "2024-03-01", "J=?date[+23hour][+61minute]": "2024-04-01",
    "K=x=y": "x",
}


@pytest.mark.parametrize("text", sorted(CONSTANTS))
def test_constants(spark, text):
    row = with_constants(spark.range(1), text, RUN.date()).first()
    assert row[1] == CONSTANTS[text]


def test_bad_constants(spark):
    for bad in ("A=x?date[-1day]", "A=?date[-1year]", "A=?day[-1day]"):
        with pytest.raises(ValueError):
            parse_constants(bad)
    with pytest.raises(ValueError, match="run date"):
        with_constants(spark.range(1), "A=?date")
    with pytest.raises(ValueError, match="already present"):
        with_constants(spark.range(1), "ID=x")
    with pytest.raises(ValueError):
        LoadSpec(custom_column="A=?date")


def test_paths(spark):
    template = "/in/@format/x_@format.parquet,[yyyyMMdd,HHmm]"
    assert resolve_path(spark, "/root", template, RUN) == "/root/in/20240331/x_1030.parquet"
    assert resolve_path(spark, "", "/in/a", RUN) == "/in/a"
    assert resolve_path(spark, "", template) == template
    assert resolve_path(spark, "", "[x]/a", RUN) == "[x]/a"
    assert resolve_path(spark, "", "/in/@format/@format,[yyyy]", RUN) == "/in/2024/@format"
    with pytest.raises(ValueError):
        resolve_path(spark, "", "/in/[yyyy]", RUN)


def test_spec_from_parameters():
    spec = LoadSpec.from_params(
        {
            "date": "2024-03-31T10:30:00", "with-log": "2", "file-filter": "a,b", "mode-type": 4,
            "host": "db", "password": "secret", "map-data-fields": "A=bit",
        },
        ledger_path="/ledger",
    )
    assert spec.date == RUN and spec.run_date == date(2024, 3, 31)
    assert (spec.with_log, spec.name_parts, spec.order, spec.bulk) == (2, ["a", "b"], "target", True)
    assert spec.rules == {"A": "bit"}
    assert (spec.insert_batch_size, spec.submit_thread_count) == (10_000, None)
    assert "secret" not in repr(spec)
    with pytest.raises(ValueError, match="ledger_path"):
        LoadSpec(with_log=1)
    with pytest.raises(ValueError):
        LoadSpec(map_data_fields="A")


URLS = {
    "MYSQL": "jdbc:mysql://h:1/db?characterEncoding=utf8",
    "POSTGRESQL": "jdbc:postgresql://h:1/db",
    "ORACLE": "jdbc:oracle:thin:@h:1:db",
    "CLICKHOUSE": "jdbc:clickhouse://h:1/db",
    "MSSQL": "jdbc:sqlserver://h:1;databaseName=db;useBulkCopyForBatchInsert=true;applicationName=t;",
}


@pytest.mark.parametrize("kind", sorted(URLS))
def test_urls(kind):
    target = JdbcTable(kind, "h", "1", "db", "t", "u", "pw")
    assert target.url == URLS[kind]
    assert "pw" not in repr(target)
    assert ("with(NoLock)" in target.probe) == (kind == "MSSQL")


def test_connection_settings():
    params = {
        "database-type": "POSTGRESQL", "host": "h", "port": 5432, "database-name": "/db",
        "destination-table": "s.t", "user": "u", "password": "pw",
    }
    target = JdbcTable.from_params(params, driver="org.postgresql.Driver")
    assert target.url == "jdbc:postgresql://h:5432/db"
    assert target.connection["driver"] == "org.postgresql.Driver"
    options = target.write_options(500, 4, "partition")
    assert (options["dbtable"], options["batchsize"], options["numPartitions"]) == ("s.t", "500", "4")
    assert "isolationLevel" not in options
    assert "numPartitions" not in target.write_options(500, None, "partition")
    given = JdbcTable.from_params({**params, "driver": "d.D", "jdbc-options": "ssl=true;sslmode=a=b"})
    assert [given.connection[k] for k in ("driver", "ssl", "sslmode")] == ["d.D", "true", "a=b"]
    ranged = target.range_options("k", 1, 9, 4)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("k", "1", "9", "4")
    assert "k IS NOT NULL" in ranged["dbtable"]
    assert target.write_options(1, None, "batch")["isolationLevel"] == "NONE"
    with pytest.raises(ValueError):
        target.write_options(1, None, "never")
    with pytest.raises(ValueError, match="unknown database kind"):
        JdbcTable("NONE", "", "", "", "")
    source, select = JdbcTable.from_config(
        "databasetype=MYSQL;host=h;port=1;schema=db;table=t;user=u;password=p=q;select=a,b"
    )
    assert source.password == "p=q"
    assert (source.url, source.table, select) == (URLS["MYSQL"], "t", "a,b")
    assert JdbcTable.from_config("databasetype=MYSQL")[1] == "*"


def test_a_whole_table_through_one_task_must_be_asked_for(spark):
    with pytest.raises(ValueError, match="partition_on"):
        JdbcTable("MYSQL", "h", "1", "db", "t").read(spark)


def test_a_column_without_values_deals_nothing_out(spark, monkeypatch):
    monkeypatch.setattr(JdbcTable, "_range", lambda self, spark, column: (None, None))
    with pytest.raises(ValueError, match="no value"):
        JdbcTable("MYSQL", "h", "1", "db", "t").read(spark, partition_on="k")


def test_rows_without_a_value_have_a_connection_of_their_own(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, _):
            return self

        def option(self, *_):
            return self

        def options(self, **given):
            seen.update(given)
            return self

        def load(self):
            return spark.range(3)

        def jdbc(self, url, table, predicates, properties):
            seen["predicates"] = predicates
            return spark.range(2)

    monkeypatch.setattr(JdbcTable, "_range", lambda self, spark, column: (1, 9))
    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    df = JdbcTable("MYSQL", "h", "1", "db", "t").read(spark, partition_on="k", partitions=4)
    assert df.count() == 5 and seen["predicates"] == ["k IS NULL"] and seen["numPartitions"] == "4"


def test_slices_of_equal_rows_are_asked_of_the_database(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, _):
            return self

        def options(self, **_):
            return self

        def option(self, name, value):
            seen[name] = value
            return self

        def load(self):
            return spark.sql("SELECT * FROM VALUES (3), (7), (7), (9) AS t(first_value)")

        def jdbc(self, url, table, predicates, properties):
            seen["predicates"] = predicates
            return spark.range(2)

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    table = JdbcTable("MYSQL", "h", "1", "db", "t")
    table.read(spark, partition_on="k", partitions=4, equal_rows=True)
    assert "NTILE(4) OVER (ORDER BY k)" in seen["query"]
    assert seen["predicates"] == ["(k < 7 OR k IS NULL)", "k >= 7 AND k <= 7", "k > 7 AND k < 9", "k >= 9"]
    # the keys of a load are read the same way they are cut: by the first column that has an order
    monkeypatch.setattr(JdbcTable, "schema", lambda self, spark: spark.sql("SELECT 'x' a, 1 b").schema)
    monkeypatch.setattr(JdbcTable, "read", lambda self, spark, columns, **how: seen.update(how))
    table.key_rows(spark, ["a", "B"])
    assert (seen["partition_on"], seen["partitions"]) == ("B", None)
    table.key_rows(spark, ["a"])
    assert (seen["partition_on"], seen["partitions"]) == (None, 1)


def test_path_in_a_gap_of_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = datetime(2024, 3, 10, 2, 30)
        assert resolve_path(spark, "/in", "/@format,[yyyyMMddHHmm]", at) == "/in/202403100230"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_commit_and_predicates_come_from_parameters():
    spec = LoadSpec.from_params({"commit": "batch", "predicates": "a = 1;a <> 1", "submit-thread-count": "4"})
    assert (spec.commit, spec.predicates, spec.submit_thread_count) == ("batch", ("a = 1", "a <> 1"), 4)
    with pytest.raises(ValueError, match="commit"):
        LoadSpec(commit="never")


def test_vendor_types_come_from_the_driver():
    schema = T.StructType(
        [
            T.StructField("a", T.StringType(), metadata={"jdbcClientType": "FixedString(16)"}),
            T.StructField("b", T.LongType(), metadata={"jdbcClientType": "int8"}),
            T.StructField("c", T.DecimalType(10, 2)),
        ]
    )
    types = JdbcTable("CLICKHOUSE", "h", "1", "db", "t").vendor_types(schema)
    assert types == {"a": "FIXEDSTRING", "b": "INT8", "c": "DECIMAL"}


class FakeConnection:
    def __init__(self):
        self.log = []

    def __getattr__(self, name):
        def call(*args):
            self.log.append((name, *map(str, args)))
            return self

        return call


@pytest.mark.parametrize("kind", ["MSSQL", "CLICKHOUSE"])
def test_database_scripts(spark, monkeypatch, kind):
    connection = FakeConnection()
    monkeypatch.setattr(JdbcTable, "_connect", lambda self, spark: connection)
    script = split_script("delete from t where d = ?;; exec p;")
    JdbcTable(kind, "h", "1", "db", "t").run(spark, script, RUN.date())
    bound = (
        [("prepareCall", "delete from t where d = ?"), ("setDate", "1", "2024-03-31"), ("execute",)]
        if kind == "MSSQL"
        else [("createStatement",), ("execute", "delete from t where d = '2024-03-31'")]
    )
    assert connection.log == [
        ("setAutoCommit", "False"), *bound, ("close",), ("commit",),
        ("createStatement",), ("execute", " exec p"), ("close",), ("commit",), ("close",),
    ]
    with pytest.raises(ValueError, match="run date"):
        JdbcTable(kind, "h", "1", "db", "t").run(spark, ["x ?"], None)
    assert connection.log[-1] == ("close",)


def test_run_from_parameters(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        "quayside.plans.load.run",
        lambda spark, spec, target, source: seen.update(spec=spec, target=target, source=source),
    )
    run_params(
        spark,
        {
            "data-type": "DB", "source-db-config": "databasetype=MYSQL;table=s;select=a,b",
            "database-type": "ORACLE", "destination-table": "t",
        },
        partition_on="a",
    )
    assert seen["source"].table == "s" and seen["target"].kind == "ORACLE"
    assert (seen["spec"].source_columns, seen["spec"].partition_on) == ("a,b", "a")
