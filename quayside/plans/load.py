"""The load envelope: select, align, convert, write, record, with scripts around it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Outcome
from ..operators.align import align, with_constants
from ..operators.convert import bulk_outcomes, coerce_to_target, convert_outcomes, values
from ..operators.widths import limit_widths, text_limits
from ..session import compiled_methods
from ..sinks.once import forget, publish
from ..sources.files import escape_glob, scan_parquet, source_stats
from ..spec import Hook, LoadSpec, resolve_path
from ..streaming.ingest import arrivals
from ..streaming.ledger import Ledger
from ..tables import JdbcTable, Table, split_script
from .stage import Stage

#: Column of a stage's source rows that holds their file.
ORIGIN = "_quayside_file"


@dataclass
class LoadReport:
    """What a run did.  ``ran`` is False if there was nothing to load."""

    ran: bool = False
    rows_read: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    files_recorded: int = 0
    files_short: list[str] = field(default_factory=list)
    steps: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Wave:
    """Rows to load, the files (``path``) they come from, and the token of rows that come exactly once."""

    rows: DataFrame
    files: DataFrame | None = None
    size: int = 0
    token: str | None = None
    resumed: bool = False


def run(spark: SparkSession, spec: LoadSpec, target: Table, source: Table | None = None) -> LoadReport:
    """Run one load into an existing table; ``source`` is the table of a DB load."""
    if spec.data_type == "DB" and source is None:
        raise ValueError("a DB load needs a source table")
    with compiled_methods(spark):
        if spec.data_type == "DB":
            return _run_copy(spark, spec, target, source)
        return _run_files(spark, spec, target)


def run_params(
    spark: SparkSession, params: Mapping[str, Any], root: str = "", **settings: Any
) -> LoadReport:
    """Run a load from hyphenated parameters; ``settings`` are further ``LoadSpec`` fields."""
    source = None
    if params.get("data-type") == "DB":
        source, settings["source_columns"] = JdbcTable.from_config(params["source-db-config"])
    spec = LoadSpec.from_params(params, root=root, **settings)
    return run(spark, spec, JdbcTable.from_params(params), source)


def copy_table(
    spark: SparkSession,
    source: Table,
    target: Table,
    columns: str = "*",
    batch_size: int = 10_000,
    parallelism: int | None = None,
    commit: str = "partition",
    **read: object,
) -> None:
    """Append the columns two tables share; ``read`` goes to the source's ``read``."""
    target.write(
        copied_rows(spark, source, target, columns, **read),
        batch_size=batch_size,
        parallelism=parallelism,
        commit=commit,
    )


def copied_rows(
    spark: SparkSession, source: Table, target: Table, columns: str = "*", **read: object
) -> DataFrame:
    """Rows of a table-to-table copy, coerced to the destination's types."""
    schema = target.schema(spark)
    rows = align(source.read(spark, columns.split(","), **read), schema)
    return coerce_to_target(rows, target.vendor_types(schema), schema)


def transform(df: DataFrame, spec: LoadSpec, schema: T.StructType) -> DataFrame:
    """Source rows as the destination takes them, nothing rejected."""
    aligned = align(df, schema, spec.order)
    outcomes = row_outcomes(aligned, spec, schema)
    return with_constants(aligned.select(values(outcomes)), spec.constants, spec.run_date)


def row_outcomes(aligned: DataFrame, spec: LoadSpec, schema: T.StructType) -> dict[str, Outcome]:
    """Outcomes by column; the bulk modes send text without quotes, empty text as NULL."""
    if not spec.bulk:
        return convert_outcomes(aligned, spec.rules, schema, spec.int96_noon)
    outcomes = bulk_outcomes(aligned, spec.rules, spec.int96_noon)
    return {
        name: Outcome(F.nullif(F.replace(o.value, F.lit("'")), F.lit("")), o.ok)
        for name, o in outcomes.items()
    }


# -- Parquet to table ---------------------------------------------------------


def _run_files(spark: SparkSession, spec: LoadSpec, target: Table) -> LoadReport:
    path = resolve_path(spark, spec.root, spec.source_file_expression, spec.date)
    if spec.with_log <= 0:
        rows = scan_parquet(spark, path, name_parts=spec.name_parts, merge_schema=spec.merge_schema)
        return _run_waves(spark, spec, target, [Wave(rows)], None)
    ledger = Ledger(spark, spec.ledger_path)
    return _run_waves(spark, spec, target, _waves(spark, spec, target, path, ledger), ledger)


def _run_waves(
    spark: SparkSession, spec: LoadSpec, target: Table, waves: Iterable[Wave], ledger: Ledger | None
) -> LoadReport:
    report = LoadReport()
    schema, skipped = None, []
    try:
        for wave in waves:
            if not report.ran:
                # nothing at all runs for empty input, scripts included
                if wave.rows.isEmpty():
                    skipped.append(wave)
                    continue
                _hook(spark, spec.script_before, target, spec, report, "before")
                report.ran = True
                schema = target.schema(spark)
            if ledger is not None and not wave.resumed:
                ledger.open_wave(wave.token, wave.files)
            if wave.token is None or not target.written(spark, wave.token):
                wave = _load_wave(spark, spec, target, schema, wave, report, ledger)
            if ledger is not None:
                # empty files of a run that loads something are done, however it is cut into waves
                for done in [*skipped, wave]:
                    ledger.record(done.files.coalesce(1))
                    report.files_recorded += done.size
                    _close(spark, spec, target, ledger, done.token)
                skipped = []
    except Exception as error:
        if report.ran:
            for hook, step in ((spec.on_error, "error"), (spec.script_after, "after")):
                try:
                    _hook(spark, hook, target, spec, report, step)
                except Exception as own:
                    # the load's exception is the one to see
                    error.add_note(f"the {step} hook failed too: {own}")
        raise
    if report.ran:
        _hook(spark, spec.script_after, target, spec, report, "after")
    return report


def _close(spark: SparkSession, spec: LoadSpec, target: Table, ledger: Ledger, token: str) -> None:
    """A wave is in the ledger: nobody will ask for its token again."""
    ledger.close_wave(token)
    target.forget(spark, token)
    if spec.rejects_path is not None:
        forget(spark, spec.rejects_path, [token])


def _waves(spark: SparkSession, spec: LoadSpec, target: Table, path: str, ledger: Ledger) -> Iterator[Wave]:
    """First what an earlier run has left open, then bounded numbers of pending files, all of these under one schema."""
    for token, files in ledger.open_waves():
        left = ledger.pending(files)
        paths = [r.path for r in left.collect()]
        if paths:
            yield Wave(_scan(spark, spec, path, paths), left, len(paths), token, resumed=True)
        else:
            # recorded, but not yet closed
            _close(spark, spec, target, ledger, token)
    source = path if spec.arrivals_path is None else arrivals(spark, path, spec.arrivals_path)
    manifest = ledger.plan(source, spec.name_parts, spec.with_log, spec.date)
    try:
        first = manifest.first()
        if first is None:
            return
        schema = _scan(spark, spec, path, [first]).schema
        for files in manifest.waves(spec.wave_files):
            paths = [r.path for r in files.collect()]
            rows = scan_parquet(spark, [escape_glob(p) for p in paths], schema=schema)
            yield Wave(rows, files, len(paths), uuid.uuid4().hex)
    finally:
        manifest.remove()


def _scan(spark: SparkSession, spec: LoadSpec, path: str, paths: list[str]) -> DataFrame:
    """Rows of some files, under the schema of the first or the merged one of their folder."""
    schema = None
    if spec.merge_schema:
        # Spark merges the footers in a job of its own
        schema = scan_parquet(spark, path, name_parts=spec.name_parts, merge_schema=True).schema
    elif len(paths) > 1:
        schema = scan_parquet(spark, escape_glob(paths[0])).schema
    return scan_parquet(spark, [escape_glob(p) for p in paths], schema=schema)


def _load_wave(
    spark: SparkSession, spec: LoadSpec, target: Table, schema: T.StructType, wave: Wave, report: LoadReport,
    ledger: Ledger | None,
) -> Wave:
    """Load one wave; gives the wave that was loaded, without the files that were read short."""
    settings = {"batch_size": spec.insert_batch_size, "parallelism": spec.submit_thread_count, "commit": spec.commit}
    if wave.token is not None:
        settings["token"] = wave.token
    aligned = align(wave.rows, schema, spec.order)
    if not spec.staged:
        observed = Observation()
        good = aligned.select(values(row_outcomes(aligned, spec, schema))).observe(observed, F.count(F.lit(1)).alias("rows"))
        target.write(with_constants(good, spec.constants, spec.run_date), **settings)
        report.rows_read += observed.get["rows"]
        report.rows_written += observed.get["rows"]
        return wave
    stage = Stage(spark, *_staged_rows(spec, schema, wave, aligned), spec.keys)
    try:
        if spec.verify_files:
            wave = _without_short_files(spark, stage, wave, ledger, report)
        clashing = stage.find_clashes(target.key_rows(spark, spec.keys), schema) if spec.keys else 0
        rejected = stage.rejected + clashing
        # rejects go first: once the rows are in the table, their keys would clash with themselves
        if rejected and wave.token is None:
            stage.rejects().write.mode("append").parquet(spec.rejects_path)
        elif rejected:
            publish(stage.rejects(), spec.rejects_path, wave.token)
        target.write(with_constants(stage.good_rows(), spec.constants, spec.run_date), **settings)
    finally:
        stage.remove()
    report.rows_read += stage.rows
    report.rows_rejected += rejected
    report.rows_written += stage.rows - rejected
    return wave


def _staged_rows(
    spec: LoadSpec, schema: T.StructType, wave: Wave, aligned: DataFrame
) -> tuple[DataFrame, dict[str, Outcome], str | None]:
    """Source rows, their outcomes, and the name of the column that holds their file."""
    outcomes = row_outcomes(aligned, spec, schema)
    if spec.rejects_path is None:
        outcomes = {name: Outcome(o.value) for name, o in outcomes.items()}
    else:
        texts = T.StructType([T.StructField(n, T.StringType()) for n in outcomes])
        outcomes = limit_widths(outcomes, text_limits(texts, schema, spec.column_width))
    if not spec.verify_files:
        return aligned, outcomes, None
    rows = wave.rows.withColumn(ORIGIN, F.col("_metadata.file_path"))
    return align(rows, [*aligned.columns, ORIGIN], "target"), outcomes, ORIGIN


def _without_short_files(
    spark: SparkSession, stage: Stage, wave: Wave, ledger: Ledger, report: LoadReport
) -> Wave:
    """The wave less the files that were read short, in the stage and in what an interrupted run will find open."""
    short = _short_files(stage, wave)
    if not short:
        return wave
    stage.leave_out(short)
    report.files_short += short
    paths = [p for p in (r.path for r in wave.files.collect()) if p not in short]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    ledger.open_wave(wave.token, files)
    return replace(wave, files=files, size=len(paths))


def _short_files(stage: Stage, wave: Wave) -> list[str]:
    """Files of which fewer (or more) rows were read than their footers tell.

    Both sides hold a row a file of the wave; a scan of no column reads footers only.  The expected counts fail
    loudly where a footer cannot be read.
    """
    expected = source_stats(wave.rows).withColumnRenamed("row_count", "expected")
    found = stage.rows_by_file().withColumnRenamed("file", "file_path")
    both = expected.join(found, "file_path", "left").where("expected <> coalesce(row_count, 0)")
    return [r.file_path for r in both.select("file_path").collect()]


# -- table to table -----------------------------------------------------------


def _run_copy(spark: SparkSession, spec: LoadSpec, target: Table, source: Table) -> LoadReport:
    report = LoadReport(ran=True)
    _hook(spark, spec.script_before, target, spec, report, "before")
    observed = Observation()
    read = {
        "partitions": spec.read_partitions, "partition_on": spec.partition_on,
        "predicates": spec.predicates, "equal_rows": spec.equal_rows > 0,
    }
    rows = copied_rows(spark, source, target, spec.source_columns, **read)
    target.write(
        rows.observe(observed, F.count(F.lit(1)).alias("rows")),
        batch_size=spec.insert_batch_size,
        parallelism=spec.submit_thread_count,
        commit=spec.commit,
    )
    report.rows_read = report.rows_written = observed.get["rows"]
    _hook(spark, spec.script_after, target, spec, report, "after")
    return report


def _hook(
    spark: SparkSession, hook: Hook, target: Table, spec: LoadSpec, report: LoadReport, step: str
) -> None:
    if hook is None:
        return
    if callable(hook):
        hook(spark)
    else:
        target.run(spark, split_script(hook), spec.run_date)
    report.steps.append(step)
