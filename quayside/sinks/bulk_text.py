"""Bulk text files: tab after every field, CRLF after every row, no quotes.

The form that bulk-load tools of databases read without a header.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import quoted, with_constants
from ..operators.convert import bulk_outcomes
from ..functions.rules import Outcome
from ..operators.rejects import good_rows, rejected_rows
from ..spec import Constant


def split_bulk(
    df: DataFrame,
    rules: str | Mapping[str, str] = "",
    constants: str | Iterable[Constant] = "",
    run_date: date | None = None,
    int96_noon: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(lines, rejects)``: one ``value`` per row, and the rows a line cannot hold."""
    outcomes = {n: _unbroken(o) for n, o in bulk_outcomes(df, rules, int96_noon).items()}
    good = with_constants(good_rows(df, outcomes), constants, run_date)
    return bulk_lines(good), rejected_rows(df, outcomes)


def _unbroken(outcome: Outcome) -> Outcome:
    """A tab or line break in a value would break its line, so such values do not fit."""
    whole = outcome.value.isNull() | ~outcome.value.rlike(r"[\t\r\n]")
    return Outcome(outcome.value, whole if outcome.ok is None else outcome.ok & whole)


def bulk_lines(df: DataFrame) -> DataFrame:
    """Text columns as one line each: NULL is empty, every ``'`` is dropped."""
    fields = [
        F.concat(F.coalesce(F.replace(quoted(c), F.lit("'")), F.lit("")), F.lit("\t"))
        for c in df.columns
    ]
    return df.select(F.concat(*fields).alias("value"))


def write_bulk_text(lines: DataFrame, path: str, compression: str = "none") -> None:
    """Write lines below ``path``, a file per partition."""
    (
        lines.write.option("lineSep", "\r\n").option("compression", compression)
        .mode("append").text(path)
    )
