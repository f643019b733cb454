"""Loads that split in one pass, write exactly once, and stay whole wherever they are cut short."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import quayside.streaming.ledger as ledger_module
from quayside import CatalogTable, JdbcTable, Ledger, LoadSpec, align, list_files, run, scan_parquet, stream_parquet
from quayside.operators.convert import convert_outcomes
from quayside.operators.widths import declared_limit, text_limits
from quayside.plans.stage import Stage
from quayside.sinks import once
from quayside.sinks.once import Folder, publish
from quayside.sources.files import footer_counts
from quayside.streaming.ingest import ingest_table
from quayside.tables import slice_predicates, sql_literal

from test_loads import RUN, add_file, folder, keys, spec, target  # noqa: F401

ROOT_OF_TESTS = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class Crash(RuntimeError):
    pass


def failing(monkeypatch, owner, name, when=lambda *a: True, after=False):
    """Let a method fail where ``when`` says so, before or after its work; gives a call that mends it."""
    real = getattr(owner, name)

    def call(*args, **more):
        if after:
            real(*args, **more)
        if when(*args):
            raise Crash(name)
        return None if after else real(*args, **more)

    monkeypatch.setattr(owner, name, call)
    return lambda: monkeypatch.setattr(owner, name, real)


# -- one pass --------------------------------------------------------------------


def test_good_rows_and_rejects_come_from_one_scan(spark, folder):
    aligned = align(scan_parquet(spark, str(folder)), ["K", "v"])
    stage = Stage(spark, aligned, convert_outcomes(aligned, "v=numeric"), None)
    assert (stage.rows, stage.rejected) == (12, 4)
    good, bad = stage.good_rows(), stage.rejects()
    for df in (good, bad):
        files = df.inputFiles()
        assert files and all(stage.path.removeprefix("file:") in f for f in files)
    # a kind reads nothing of the other
    assert "raw" not in physical(good).split("ReadSchema")[1] and "row:" not in physical(bad).split("ReadSchema")[1]
    assert sorted(r.K for r in good.collect()) == [0, 1, 3, 4, 6, 7, 9, 10]
    assert sorted((r.K, r.v, r.failed_columns) for r in bad.collect()) == [(k, "x", ["v"]) for k in (2, 5, 8, 11)]
    stage.remove()
    assert not os.path.exists(stage.path.removeprefix("file:"))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- exactly once ----------------------------------------------------------------


@pytest.mark.parametrize(
    "owner, name, when, after",
    [
        (Folder, "mark", lambda f, name: True, False),
        (Folder, "mark", lambda f, name: True, True),
        (Folder, "remove", lambda f, name: "_loading" in name, False),
        (Folder, "move_files", lambda f, name: True, False),
    ],
)
def test_publish_starts_over(spark, tmp_path, monkeypatch, owner, name, when, after):
    path = str(tmp_path / "out")
    spark.range(5).write.parquet(path)
    mend = failing(monkeypatch, owner, name, when, after)
    with pytest.raises(Crash):
        publish(spark.range(10, 16).repartition(3), path, "t1")
    mend()
    # what was computed is not computed again
    publish(spark.range(99), path, "t1")
    publish(spark.range(99), path, "t1")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [*range(5), *range(10, 16)]
    assert not os.path.exists(f"{path}/_loading/t1")
    assert publish(spark.range(20, 21), path, "t2") and spark.read.parquet(path).count() == 12


def test_publish_after_half_the_files_moved_or_an_unfinished_stage(spark, tmp_path):
    path = tmp_path / "out"
    spark.range(6).repartition(3).write.parquet(str(path / "_loading/t1"))
    parts = sorted(p for p in os.listdir(path / "_loading/t1") if p.startswith("part-"))
    shutil.move(path / "_loading/t1" / parts[0], path / parts[0])
    publish(spark.range(99), str(path), "t1")
    spark.range(50).write.parquet(str(path / "_loading/t2"))
    os.remove(path / "_loading/t2/_SUCCESS")
    publish(spark.range(6, 8), str(path), "t2")
    assert sorted(r.id for r in spark.read.parquet(str(path)).collect()) == [*range(8)]


def test_tables_take_a_token_once(spark, tmp_path):
    rows = spark.sql("SELECT 1 k, 'a/b' p, 'xy   ' t UNION ALL SELECT 2, 'c', NULL")
    for create in (
        "k INT, p STRING, t VARCHAR(3)) USING parquet", "k INT, p STRING, t VARCHAR(3)) USING orc PARTITIONED BY (p)",
    ):
        table = CatalogTable(f"t_{uuid.uuid4().hex}")
        spark.sql(f"CREATE TABLE {table.table} ({create}")
        for token in ("a", "a", "b", "a"):
            table.write(rows, token=token)
        assert sorted((r.k, r.p, r.t) for r in spark.table(table.table).collect()) == sorted([(1, "a/b", "xy "), (2, "c", None)] * 2, key=repr)
        with pytest.raises(Exception, match="longer than 3"):
            table.write(spark.sql("SELECT 3 k, 'd' p, 'four' t"), token="c")
        table.forget(spark, "a")
        assert table.written(spark, "b") and not table.written(spark, "a")
    plain = CatalogTable(f"t_{uuid.uuid4().hex}")
    spark.sql(f"CREATE TABLE {plain.table} (k INT, p STRING, t STRING) USING json")
    plain.write(rows, token="a")
    assert plain.place(spark) is None and spark.table(plain.table).count() == 2


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("more", [{}, {"rejects_path": "rejects"}, {"rejects_path": "rejects", "key_columns": "k", "verify_files": True}])
def test_a_run_cut_short_loads_every_row_once(spark, folder, tmp_path, target, monkeypatch, more, after):
    more = {k: str(tmp_path / v) if v == "rejects" else v for k, v in more.items()}
    load_spec = spec(folder, tmp_path, wave_files=3, **more)
    mend = failing(monkeypatch, Ledger, "record", after=after)
    with pytest.raises(Crash):
        run(spark, load_spec, target)
    mend()
    # the interrupted wave is taken up as it was, though files have come since
    add_file(spark, tmp_path, folder / "aa_early.parquet", 9, datetime(2024, 1, 1))
    run(spark, load_spec, target)
    expected = [k for k in [*range(12), 27, 28, 29] if not more or k % 3 < 2]
    assert keys(spark, target) == expected
    if more:
        assert sorted(r.k for r in spark.read.parquet(more["rejects_path"]).collect()) == [2, 5, 8, 11, 29]
    assert not run(spark, load_spec, target).ran
    place = target.place(spark)[0].removeprefix("file:")
    assert os.listdir(f"{place}/_loaded") == [] and os.listdir(tmp_path / "ledger/_open") == []


def test_rejects_are_written_before_rows(spark, folder, tmp_path, target, monkeypatch):
    """With keys asked for, rows of a cut run do not clash with themselves."""
    load_spec = spec(folder, tmp_path, rejects_path=str(tmp_path / "rejects"), key_columns="K")
    mend = failing(monkeypatch, once.Folder, "mark", lambda f, name: "rejects" not in f.path and "_loaded" in name)
    with pytest.raises(Crash):
        run(spark, load_spec, target)
    mend()
    run(spark, load_spec, target)
    assert keys(spark, target) == [0, 1, 3, 4, 6, 7, 9, 10]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 4


def test_a_replayed_batch_adds_no_row(spark, folder, tmp_path, target):
    schema, checkpoint = spark.read.parquet(str(folder)).schema, tmp_path / "checkpoint"
    for replay in (False, True):
        if replay:
            last = max(int(n) for n in os.listdir(checkpoint / "commits") if n.isdigit())
            Folder(spark, str(checkpoint / "commits")).remove(str(last))
        ingest_table(align(stream_parquet(spark, str(folder), schema, max_files=2), ["k"]), target, str(checkpoint))
        assert keys(spark, target) == [*range(12)]
    # another stream is another token
    ingest_table(align(stream_parquet(spark, str(folder), schema, ["a_", "b_"]), ["k"]), target, str(tmp_path / "other"))
    assert keys(spark, target) == sorted([*range(12), *range(6)])


# -- ledger ------------------------------------------------------------------------


def statuses(ledger):
    latest = ledger.entries().groupBy("path").agg(F.max_by("status", "completed_at").alias("s"))
    return {r.path: r.s for r in latest.collect()}


def files_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "path string").coalesce(1)


def test_many_waves_leave_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_module, "LOG_FILES", 8)
    monkeypatch.setattr(ledger_module, "BUCKET_PATHS", 10)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for wave in range(40):
        ledger.record(files_of(spark, [f"/f{wave}"]))
    assert ledger.generation() == 5
    parts = [p for _, _, names in os.walk(tmp_path / "ledger") for p in names if p.endswith(".parquet")]
    assert len(parts) <= 2 * (8 + 5)
    assert statuses(ledger) == {f"/f{wave}": "complete" for wave in range(40)}
    ledger.record(files_of(spark, ["/f3", "/f50"]), "failed")
    assert statuses(ledger) | {"/f3": "failed", "/f50": "failed"} == statuses(ledger)
    pending = ledger.pending(files_of(spark, ["/f1", "/f3", "/f50", "/new", "/f39"]))
    assert sorted(r.path for r in pending.collect()) == ["/f3", "/f50", "/new"]
    # a session that does not know the tables reads the same folder
    spark.sql(f"DROP TABLE {ledger._table(5)}")
    assert len(statuses(Ledger(spark.newSession(), str(tmp_path / "ledger")))) == 41


@pytest.mark.parametrize("name, after", [("mark", False), ("mark", True), ("remove", False), ("remove", True)])
def test_compaction_cut_short_loses_nothing(spark, tmp_path, monkeypatch, name, after):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for wave in range(3):
        ledger.record(files_of(spark, [f"/f{wave}"]))
        if wave < 2:
            ledger.compact()
    before = statuses(ledger)
    mend = failing(monkeypatch, Folder, name, after=after)
    with pytest.raises(Crash):
        ledger.compact()
    mend()
    assert statuses(ledger) == before
    ledger.record(files_of(spark, ["/f9"]))
    ledger.compact()
    assert statuses(Ledger(spark, ledger.path)) == before | {"/f9": "complete"}


def test_history_is_read_where_it_lies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_module, "BUCKET_PATHS", 100)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.record(spark.range(400).selectExpr("concat('/f', id) path"))
    ledger.compact()
    ledger.record(files_of(spark, ["/f500"]))
    pending = ledger.pending(spark.range(300, 600).selectExpr("concat('/f', id) path"))
    lines = physical(pending).split("\n")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    assert "SelectedBucketsCount: 4 out of 4" in lines[at]
    above = []
    for line in reversed(lines[:at]):
        above.append(line)
        if "Sort [_done" in line:
            break
    assert not any("Exchange" in line for line in above) and len(above) == 3, "\n".join(lines)
    assert pending.count() == 199 and "Broadcast" not in physical(pending)


# -- files read short -----------------------------------------------------------------


def test_a_file_read_short_stays_pending(spark, folder, tmp_path, target):
    bad = folder / "a_103000_0.parquet"
    whole = bad.read_bytes()
    bad.write_bytes(whole[:4] + b"\xff" * 60 + whole[64:])
    load_spec = spec(folder, tmp_path, verify_files=True, rejects_path=str(tmp_path / "rejects"))
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        report = run(spark, load_spec, target)
    finally:
        spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    assert [p.rsplit("/", 1)[1] for p in report.files_short] == [bad.name] and report.files_recorded == 3
    assert keys(spark, target) == [3, 4, 6, 7, 9, 10]
    bad.write_bytes(whole)
    report = run(spark, load_spec, target)
    assert (report.files_recorded, report.rows_written, report.rows_rejected, report.files_short) == (1, 2, 1, [])
    assert keys(spark, target) == [0, 1, 3, 4, 6, 7, 9, 10]


# -- keys, widths ------------------------------------------------------------------------


def test_hot_and_missing_keys(spark, tmp_path):
    """A third of the rows share a key: one of them is loaded, and no row of another key is lost."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) a", "if(id % 30 = 1, null, 'x') b", "id c")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (A DECIMAL(12,0), b STRING, c BIGINT) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES (2, 'x', -5), (2, 'y', -6), (5, NULL, -7)")
    load_spec = LoadSpec(root=str(tmp_path / "in"), rejects_path=str(tmp_path / "rejects"), key_columns="a,B")
    report = run(spark, load_spec, CatalogTable(name))
    bad = spark.read.parquet(str(tmp_path / "rejects"))
    assert (report.rows_read, report.rows_rejected) == (3000, 1000) and bad.count() == 1000
    assert {tuple(f.lower() for f in r.failed_columns) for r in bad.collect()} == {("a", "b")}
    assert bad.where("a = -1").count() == 999 and bad.where("a = 2").count() == 1
    assert spark.table(name).count() == 2003
    with pytest.raises(ValueError, match="key columns"):
        run(spark, LoadSpec(root=str(tmp_path / "in"), rejects_path=str(tmp_path / "r2"), key_columns="zz"), CatalogTable(name))
    with pytest.raises(ValueError, match="rejects_path"):
        LoadSpec(key_columns="a")


def test_declared_widths(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (v VARCHAR(2), c CHAR(3), s STRING, k INT) USING parquet")
    schema = spark.table(name).schema
    assert [declared_limit(f) for f in schema] == [2, 3, None, None]
    assert text_limits(T.StructType([T.StructField("V", T.StringType()), T.StructField("s", T.StringType())]), schema, 9) == {"V": 2, "s": 9}
    spark.sql("SELECT 'ab' v, 'x' c, 'long enough' s UNION ALL SELECT 'é  ', 'abcd', 's' UNION ALL SELECT 'abc', NULL, 's'").write.parquet(str(tmp_path / "in"))
    for width, good in ((None, 1), (5, 0)):
        spec_ = LoadSpec(root=str(tmp_path / "in"), rejects_path=str(tmp_path / f"bad{width}"), column_width=width)
        assert run(spark, spec_, CatalogTable(name)).rows_written == good
    bad = {(r.v, tuple(r.failed_columns)) for r in spark.read.parquet(str(tmp_path / "bad5")).collect()}
    assert bad == {("ab", ("s",)), ("é  ", ("c",)), ("abc", ("v",))}


# -- counts, slices, arrivals ----------------------------------------------------------


def test_counts_come_from_footers(spark, folder):
    counts = footer_counts(spark, [str(folder), str(folder / "c_230000.parquet")])
    assert [r.row_count for r in counts.orderBy("path").collect()] == [15, 3]
    assert counts._jdf.queryExecution().toString().count("PushedAggregation: [COUNT(*)]") >= 2


def test_slice_predicates():
    assert slice_predicates("c", [1, 5, 9]) == ["(c < 5 OR c IS NULL)", "c >= 5 AND c < 9", "c >= 9"]
    assert slice_predicates("c", [1, 5, 5, 5, 9]) == ["(c < 5 OR c IS NULL)", "c >= 5 AND c <= 5", "c > 5 AND c < 9", "c >= 9"]
    assert slice_predicates("c", [None, 3, 3]) == ["(c <= 3 OR c IS NULL)", "c > 3"]
    assert slice_predicates("c", []) == slice_predicates("c", [4]) == ["1=1"]
    assert slice_predicates("d", [date(2024, 1, 1), date(2024, 2, 1)], "ORACLE")[1] == "d >= DATE '2024-02-01'"
    assert slice_predicates("d", [date(2024, 1, 1), date(2024, 2, 1)], "MSSQL")[1] == "d >= '2024-02-01'"
    assert sql_literal(datetime(2024, 1, 2, 3, 4, 5), "MYSQL") == "TIMESTAMP '2024-01-02 03:04:05'"
    assert (sql_literal(Decimal("1E+3")), sql_literal("o'x"), sql_literal(-2.5)) == ("1000", "'o''x'", "-2.5")
    table = JdbcTable("POSTGRESQL", "h", "1", "d", "public.t")
    assert table.slice_starts("k", 8) == (
        "SELECT MIN(v) AS first_value FROM (SELECT k AS v, NTILE(8) OVER (ORDER BY k) AS slice "
        "FROM public.t WHERE k IS NOT NULL) numbered GROUP BY slice"
    )


def test_slices_of_a_skewed_column_hold_equal_shares(spark):
    """Powers of ten crowd at the low end and one value holds a third of all rows; equal widths would be far off."""
    name = f"skewed_{uuid.uuid4().hex}"
    spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 70 when id % 1000 = 1 then null else cast(pow(10, (id % 997) / 100) as bigint) end cut", "id"
    ).createOrReplaceTempView(name)
    table, slices = CatalogTable(name), 20
    predicates = slice_predicates("cut", table.slice_starts(spark, "cut", slices))
    counts = [spark.table(name).where(p).agg(F.count("*"), F.count_distinct("cut")).first() for p in predicates]
    assert sum(c[0] for c in counts) == 30_000
    assert all(n <= 2 * 30_000 / slices or values == 1 for n, values in counts)
    assert sum(values == 1 and n > 2 * 30_000 / slices for n, values in counts) == 1
    rows = table.read(spark, ["id"], predicates=predicates)
    assert sorted(r.id for r in rows.collect()) == [*range(30_000)]


def test_files_that_are_not_due_wait(spark, folder, tmp_path, target):
    def loaded(at, mode):
        more = spec(folder, tmp_path, with_log=mode, date=at, arrivals_path=str(tmp_path / "arrivals"))
        run(spark, more, target)
        return keys(spark, target)

    assert loaded(datetime(2024, 3, 30, 12), 1) == [6, 7, 8]
    assert loaded(datetime(2024, 3, 30, 13), 1) == [6, 7, 8]
    add_file(spark, tmp_path, folder / "late_235959_.parquet", 9, datetime(2024, 4, 2))
    assert loaded(RUN, 3) == [0, 1, 2, 6, 7, 8, 9, 10, 11]
    assert loaded(datetime(2024, 3, 31, 23, 59, 59), 3) == [*range(12), 27, 28, 29]
    listed = {r.path for r in list_files(spark, str(folder)).collect()}
    assert listed == {r.path for r in Ledger(spark, str(tmp_path / "ledger")).entries().collect()}


# -- the removable part ------------------------------------------------------------------


def test_entry_points_stand_without_a_package_of_the_removable_part():
    code = (
        "import sys; sys.modules['tiktoken'] = None\n"
        "import __spark_entry__ as e\n"
        "assert 'load_orders' in e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    )
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, cwd=ROOT_OF_TESTS)


def test_shared_folders_go_with_the_driver(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from quayside.session import shared_dir\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "path = shared_dir(spark, 'x')\n"
        "spark.range(3).write.parquet(path)\n"
        "assert spark.read.parquet(path).count() == 3\n"
        "spark.stop()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT_OF_TESTS, capture_output=True)
    assert not list(tmp_path.glob("*x-*"))
