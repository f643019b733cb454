"""A wave's rows, converted once and kept until all that is made of them is written.

One pass over the source writes the converted row of each good one, and the unchanged row and failing columns of each
bad one, into a stage in the shared folder.  Good rows, rejects, counts by file and clashing keys are all read from
there: the columns of the other kind are empty, so reading one kind costs little of the other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Outcome
from ..operators.align import quoted
from ..operators.convert import values
from ..operators.rejects import FAILED, failed_columns
from ..session import remove_dir, shared_dir

#: Clashing keys that are broadcast to the rows; more are merged with them.
BROADCAST_KEYS = 500_000
ROW, RAW, FILE, PLACE = "row", "raw", "file", "place"


class Stage:
    """A written stage: ``row`` of good rows, ``raw`` and ``failed_columns`` of bad ones, ``file`` and ``place`` of both."""

    def __init__(
        self, spark: SparkSession, aligned: DataFrame, outcomes: Mapping[str, Outcome], origin: str | None,
        keys: Sequence[str] = (),
    ) -> None:
        """``aligned`` holds the source's columns and, if given, ``origin``: the file of a row."""
        self.spark, self.path = spark, shared_dir(spark, "stage")
        raw = F.struct(*[quoted(c) for c in aligned.columns if c != origin])
        judged = aligned.select(
            F.struct(values(outcomes)).alias(ROW), raw.alias(RAW), failed_columns(outcomes).alias(FAILED),
            (quoted(origin) if origin else F.lit(None).cast("string")).alias(FILE),
            F.monotonically_increasing_id().alias(PLACE),
        )
        bad, observed = F.size(FAILED) > 0, Observation()
        counts = F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")
        self.keys = [k for k in judged.schema[ROW].dataType.names if k.lower() in {w.lower() for w in keys}]
        if len(self.keys) < len(set(keys)):
            raise ValueError(f"key columns {', '.join(keys)} are not all among the loaded ones")
        # a row whose key clashes is found later and goes back as it came
        kept_raw = F.col(RAW) if keys else F.when(bad, F.col(RAW))
        parts = judged.observe(observed, *counts).select(
            F.when(~bad, F.col(ROW)).alias(ROW), kept_raw.alias(RAW), F.when(bad, F.col(FAILED)).alias(FAILED), FILE, PLACE
        )
        parts.write.parquet(self.path)
        self.staged = spark.read.schema(parts.schema).parquet(self.path)
        self.rows, self.rejected = observed.get["rows"], observed.get["rejected"]
        self.clashes: DataFrame | None = None

    def rows_by_file(self) -> DataFrame:
        """``file, row_count``; reads that column only."""
        return self.staged.groupBy(FILE).agg(F.count("*").alias("row_count"))

    def leave_out(self, files: Sequence[str]) -> None:
        """Forget the rows of some files."""
        if files:
            self.staged = self.staged.where(~F.col(FILE).isin(list(files)))
            counts = self.staged.agg(F.count("*").alias("n"), F.count(FAILED).alias("bad")).first()
            self.rows, self.rejected = counts.n, counts.bad

    def find_clashes(self, known: DataFrame, target: T.StructType) -> int:
        """Find good rows whose key is in ``known`` already or came earlier; gives their number.

        Keys with a NULL clash with nothing.  Only keys move, counted before they do; of a key that comes twice the
        first row, in the order of the stage, is good.
        """
        types = {f.name.lower(): f.dataType for f in target}
        good = self.staged.where(F.col(FAILED).isNull())
        own = good.select(*[F.col(f"{ROW}.`{k}`").cast(types[k.lower()]).alias(k) for k in self.keys], PLACE).dropna(subset=self.keys)
        counted = own.groupBy(*map(quoted, self.keys)).agg(F.count("*").alias("n"), F.min(PLACE).alias("first"))
        spelled = {c.lower(): c for c in known.columns}
        taken = known.select(*[quoted(spelled[k.lower()]).alias(k) for k in self.keys])
        repeated = counted.where("n > 1").select(*map(quoted, self.keys), "n", F.col("first"))
        present = counted.join(taken, self.keys, "left_semi").select(*map(quoted, self.keys), "n", F.lit(-1).cast("long").alias("first"))
        # a key in the table has no first row in the wave
        both = repeated.unionAll(present).groupBy(*map(quoted, self.keys)).agg(F.max("n").alias("n"), F.min("first").alias("first"))
        path = f"{self.path}-clashes"
        both.write.parquet(path)
        found = self.spark.read.schema(both.schema).parquet(path)
        told = found.agg(F.count("*").alias("keys"), F.sum(F.expr("if(first < 0, n, n - 1)")).alias("rows")).first()
        if told["keys"]:
            self._key_types = types
            self.clashes = F.broadcast(found) if told["keys"] <= BROADCAST_KEYS else found.hint("merge")
        return told["rows"] or 0

    def _met(self) -> DataFrame:
        """The good rows with ``clashes``: whether their key is another row's."""
        good = self.staged.where(F.col(FAILED).isNull())
        if self.clashes is None:
            return good.withColumn("clashes", F.lit(False))
        keys = self.clashes.select(*[quoted(k).alias(f"_key{i}") for i, k in enumerate(self.keys)], F.col("first").alias("_first"))
        on = [F.col(f"{ROW}.`{k}`").cast(self._key_types[k.lower()]) == F.col(f"_key{i}") for i, k in enumerate(self.keys)]
        return good.join(keys, on, "left").withColumn("clashes", F.coalesce(F.col("_first") != F.col(PLACE), F.lit(False)))

    def good_rows(self) -> DataFrame:
        return self._met().where("not clashes").select(f"{ROW}.*")

    def rejects(self) -> DataFrame:
        """Unchanged rows with the names of their failing columns, or of the key that clashes."""
        bad = self.staged.where(F.col(FAILED).isNotNull()).select(f"{RAW}.*", FAILED)
        if self.clashes is None:
            return bad
        names = F.array(*map(F.lit, self.keys))
        return bad.unionAll(self._met().where("clashes").select(f"{RAW}.*", names.alias(FAILED)))

    def remove(self) -> None:
        for path in (self.path, f"{self.path}-clashes"):
            remove_dir(self.spark, path)
