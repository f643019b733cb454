"""Ledger of loaded files, and runs over the files it does not hold yet.

Each finished wave of files appends its paths after its rows are committed, as a
small Parquet file of the current generation.  When a generation has gathered
``LOG_FILES`` of them, the latest entry of every path is written as the bucketed
history of the next one, and an empty marker file makes that the current one.
Until the marker is there the old generation counts, so nothing is lost wherever
a run ends; generations before the last are removed.  One run at a time appends
to a ledger.

A wave that is being loaded is kept below ``_open`` until its paths are in the
ledger.  A run that finds one there loads the same files first, under the same
token, and a table that knows the token takes none of its rows twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import listing_session, remove_dir, shared_dir
from ..sinks.once import Folder
from ..sources.files import list_files, name_predicate, select_files

COMPLETE = "complete"
SCHEMA = "path string, status string, completed_at timestamp"
#: Files of a generation's log before it is compacted, and paths of a bucket of the history.
LOG_FILES, BUCKET_PATHS = 100, 1_000_000
_CURRENT, _GENERATION, _HISTORY, _OPEN = "_current-", "_generation-", "history-", "_open"


class Ledger:
    """Files and their last status, kept below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    def generation(self) -> int:
        """The current generation; 0 is the log directly below ``path``."""
        marks = [n for n in self._folder().names() if n.startswith(_CURRENT)]
        return max((int(n.removeprefix(_CURRENT)) for n in marks), default=0)

    def _log(self, generation: int) -> str:
        return f"{self.path.rstrip('/')}/{_GENERATION}{generation}/log" if generation else self.path

    def log(self, spark: SparkSession | None = None) -> DataFrame:
        """Entries since the last compaction: at most ``LOG_FILES`` waves and what was taken over."""
        spark = spark or self.spark
        try:
            return spark.read.schema(SCHEMA).parquet(self._log(self.generation()))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], SCHEMA)

    def history(self, spark: SparkSession | None = None) -> DataFrame | None:
        """One entry a path up to the last compaction, as a table bucketed and sorted by path; None before the first."""
        spark, now = spark or self.spark, self.generation()
        if not now:
            return None
        below = f"{_GENERATION}{now}"
        [name] = [n for n in self._folder().names(below) if n.startswith(_HISTORY)]
        table = self._table(now)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (path STRING, status STRING, completed_at TIMESTAMP) USING parquet "
            f"CLUSTERED BY (path) SORTED BY (path) INTO {int(name.removeprefix(_HISTORY))} BUCKETS "
            f"LOCATION '{self.path.rstrip('/')}/{below}/{name}'"
        )
        return spark.table(table)

    def _table(self, generation: int) -> str:
        """Name under which the session's catalog knows a history, so that Spark sees its buckets."""
        return f"quayside_ledger_{hashlib.md5(self._folder().path.encode()).hexdigest()}_{generation}"

    def entries(self, spark: SparkSession | None = None) -> DataFrame:
        """Entries of the history and of the log."""
        history, log = self.history(spark), self.log(spark)
        return log if history is None else history.unionAll(log)

    def record(self, files: DataFrame, status: str = COMPLETE) -> None:
        """Append ``files`` (a ``path`` column) with the current time."""
        self.take_over(
            files.select("path", F.lit(status).alias("status"), F.current_timestamp().alias("completed_at"))
        )

    def take_over(self, entries: DataFrame) -> None:
        """Append entries as they are, with their status and time: those of an older ledger."""
        now = self.generation()
        entries.select("path", "status", "completed_at").write.mode("append").parquet(self._log(now))
        below = f"{_GENERATION}{now}/log" if now else ""
        if sum(n.endswith(".parquet") for n in self._folder().names(below)) >= LOG_FILES:
            self.compact()

    def compact(self) -> None:
        """Begin a new generation whose history is the latest entry of every path."""
        now, folder = self.generation(), self._folder()
        new, entries = now + 1, self.entries()
        latest = entries.groupBy("path").agg(F.max_by(F.struct("status", "completed_at"), "completed_at").alias("last"))
        buckets = max(1, -(-entries.count() // BUCKET_PATHS))
        below, table = f"{_GENERATION}{new}", self._table(new)
        # what an earlier attempt has left
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder.remove(below)
        rows = latest.select("path", "last.*").repartition(buckets, "path")
        writer = rows.write.bucketBy(buckets, "path").sortBy("path").format("parquet")
        writer.option("path", f"{folder.path}/{below}/{_HISTORY}{buckets}").saveAsTable(table)
        folder.mark(f"{_CURRENT}{new}")
        # the last generation stays for those who read it meanwhile
        self._remove_before(now)

    def _remove_before(self, generation: int) -> None:
        folder = self._folder()
        for name in folder.names():
            number = name.removeprefix(_CURRENT).removeprefix(_GENERATION)
            if number.isdigit() and name != number and int(number) < generation:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(int(number))}")
                folder.remove(name)
            elif generation > 0 and name.endswith(".parquet"):
                folder.remove(name)

    def pending(self, files: DataFrame) -> DataFrame:
        """``files`` whose latest entry is not complete, or that have none.

        Only the files and the log move: they are dealt to the history's buckets, which are read where they lie.
        """
        spark = files.sparkSession
        log, history = self.log(spark), self.history(spark)
        if history is None:
            return pending_files(files, log)
        done = history.where(F.col("status") == COMPLETE).select(F.col("path").alias("_done"))
        met = files.join(done.hint("merge"), files["path"] == done["_done"], "left")
        verdict = latest_complete(log).hint("merge")
        left = met.join(verdict, "path", "left").where(~F.coalesce("complete", F.col("_done").isNotNull()))
        return left.select(*files.columns)

    # -- waves that are being loaded --

    def open_wave(self, token: str, files: DataFrame) -> None:
        """Keep the files of a wave until ``close_wave``."""
        files.select("path").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{_OPEN}/{token}")

    def close_wave(self, token: str) -> None:
        self._folder().remove(f"{_OPEN}/{token}")

    def open_waves(self) -> list[tuple[str, DataFrame]]:
        """Token and files of the waves an earlier run has not finished; a run leaves one at most."""
        folder, found = self._folder(), []
        for token in folder.names(_OPEN):
            if folder.has(f"{_OPEN}/{token}/_SUCCESS"):
                files = self.spark.read.schema("path string").parquet(f"{self.path}/{_OPEN}/{token}")
                found.append((token, files))
            else:
                folder.remove(f"{_OPEN}/{token}")
        return found

    def plan(
        self, source: str | DataFrame, name_parts: list[str], mode: int, run_at: datetime | None
    ) -> Manifest:
        """Manifest of the pending files of a directory, or of a list of arrived ones, fixed for the whole run."""
        sister = listing_session(self.spark)
        if isinstance(source, str):
            listed = list_files(sister, source, name_parts)
        else:
            listed = source.where(name_predicate(F.col("name"), name_parts))
        files = select_files(listed, mode, run_at)
        path = shared_dir(self.spark, "manifest")
        pending = self.pending(files).select(F.unix_micros("modified_at").alias("micros"), "path")
        # in order, each file numbered within its part
        ordered = pending.repartitionByRange("micros", "path").sortWithinPartitions("micros", "path")
        numbered = ordered.withColumn("id", F.monotonically_increasing_id()).select(
            "path", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place")
        )
        numbered.write.partitionBy("part").parquet(path)
        return Manifest(self.spark, path)


class Manifest:
    """Written list of files to load, oldest first, handed out in bounded waves."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.files = spark.read.schema("path string, place long, part long").parquet(path)

    def _parts(self) -> list[tuple[int, int]]:
        """Number and files of each part, in order; as many as the sort had partitions."""
        counts = self.files.groupBy("part").count().orderBy("part").collect()
        return [(r["part"], r["count"]) for r in counts]

    def slice(self, parts: list[tuple[int, int]], start: int, end: int) -> DataFrame:
        """``path`` of the files numbered from start to before end; reads their parts only."""
        wanted, first = F.lit(False), 0
        for part, count in parts:
            low, high = max(start - first, 0), min(end - first, count)
            if low < high:
                wanted = wanted | ((F.col("part") == part) & (F.col("place") >= low) & (F.col("place") < high))
            first += count
        return self.files.where(wanted).select("path")

    def waves(self, size: int) -> Iterator[DataFrame]:
        """Frames of at most ``size`` paths each, the oldest files first."""
        parts = self._parts()
        for start in range(0, sum(n for _, n in parts), size):
            yield self.slice(parts, start, start + size)

    def first(self) -> str | None:
        """The oldest file."""
        row = next((wave.first() for wave in self.waves(1)), None)
        return row and row.path

    def remove(self) -> None:
        remove_dir(self.spark, self.path)


def latest_complete(entries: DataFrame) -> DataFrame:
    """Whether the latest entry of each path is complete."""
    # a flag, not the status text, keeps this a hash aggregation
    latest = F.max_by(F.col("status") == COMPLETE, "completed_at")
    return entries.groupBy("path").agg(latest.alias("complete"))


def complete_paths(entries: DataFrame) -> DataFrame:
    """Paths whose latest entry is complete."""
    return latest_complete(entries).where("complete").select("path")


def pending_files(files: DataFrame, entries: DataFrame) -> DataFrame:
    """``files`` without those the ledger holds as complete.

    Both sides are file lists that grow with the data, and the ledger compresses
    well enough to look small on disk, so they are merged and never broadcast.
    """
    return files.join(complete_paths(entries).hint("merge"), "path", "left_anti")


def read_text_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a text ledger: ``path<TAB>status;time`` per line, the last line counts."""
    lines = spark.read.text(path).select(
        F.col("value"),
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("position"),
    )
    return parse_text_ledger(lines)


def parse_text_ledger(lines: DataFrame) -> DataFrame:
    """Entries of ``value`` lines in the order of ``position``."""
    state = F.split_part("value", F.lit("\t"), F.lit(2))
    last = lines.groupBy(F.split_part("value", F.lit("\t"), F.lit(1)).alias("path")).agg(
        F.max_by(state, "position").alias("state")
    )
    return last.select(
        "path",
        F.split_part("state", F.lit(";"), F.lit(1)).alias("status"),
        F.split_part("state", F.lit(";"), F.lit(2)).try_cast("timestamp").alias("completed_at"),
    )
