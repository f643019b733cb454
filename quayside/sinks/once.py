"""Files that reach a folder exactly once, however often their writer starts over.

The rows of a token (a wave, a micro-batch) are written to a stage inside the folder, and its files are moved only when
all of them are there.  A writer that starts over finds one of four states: nothing or an unfinished stage, which is
written anew; a finished stage, whose remaining files are moved without computing anything again; or the token's
marker, and nothing is left to do.  Readers of the folder pass over stage and markers, whose names begin with ``_``.

Files move by renaming them within the folder, one after another; a reader in between sees some of them, as with any
append to a folder.  One writer a token at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

LOADING, LOADED = "_loading", "_loaded"
MARK_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


class Folder:
    """A folder in the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what a folder holds, itself excluded; none if it is missing."""
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def mark(self, name: str) -> None:
        """Create an empty file; it is there as a whole or not at all."""
        self.fs.mkdirs(self._at(name).getParent())
        self.fs.create(self._at(name), True).close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def move_files(self, source: str) -> None:
        """Move the data files below ``source`` up to the same places below the folder."""
        start = self.fs.makeQualified(self._at(source)).toString() + "/"
        found, listing = [], self.fs.listFiles(self._at(source), True)
        while listing.hasNext():
            place = listing.next().getPath().toString().removeprefix(start)
            if not place.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(place)
        for place in {p.rpartition("/")[0] for p in found} - {""}:
            self.fs.mkdirs(self._at(place))
        for place in found:
            if not self.fs.rename(self._at(f"{source}/{place}"), self._at(place)):
                raise OSError(f"could not move {place} to {self.path}")


def publish(
    df: DataFrame, path: str, token: str, partition_by: Sequence[str] = (), format: str = "parquet"
) -> bool:
    """Append ``df`` to a folder, unless the token's rows are there already; tells whether it did."""
    if finish(df.sparkSession, path, token):
        return False
    writer = df.write.mode("overwrite").format(format).option(MARK_SUCCESS, "true").partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/{LOADING}/{token}")
    return finish(df.sparkSession, path, token)


def finish(spark: SparkSession, path: str, token: str) -> bool:
    """Move what a finished stage still holds; whether the token's rows are all in the folder now."""
    folder = Folder(spark, path)
    stage, marker = f"{LOADING}/{token}", f"{LOADED}/{token}"
    if not folder.has(marker):
        if not folder.has(f"{stage}/_SUCCESS"):
            return False
        folder.move_files(stage)
        folder.mark(marker)
    folder.remove(stage)
    return True


def forget(spark: SparkSession, path: str, tokens: Iterable[str]) -> None:
    """Remove the markers of tokens that will not come again."""
    folder = Folder(spark, path)
    for token in tokens:
        folder.remove(f"{LOADED}/{token}")
