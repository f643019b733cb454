"""Text rendering and rule suggestions for raw columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import require_scalar, text_of
from .align import quoted


def as_text(df: DataFrame, empty_as_null: bool = True) -> DataFrame:
    """Every column as text; the text ``null``, and empty text unless kept, is NULL."""
    blank = ("", "null") if empty_as_null else ("null",)
    columns = []
    for field in df.schema:
        require_scalar(field)
        c = text_of(quoted(field.name))
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            c = F.when(~c.isin(*blank), c)
        columns.append(c.alias(field.name))
    return df.select(columns)


def suggest_rules(df: DataFrame, separator: str = "/") -> DataFrame:
    """One row per text column: ``date1`` if any value proves month-first dates, else ``date0``.

    Proof is a numeric text whose parts are a month, a number above 12 and a
    part of more than three digits.  One pass, whatever the number of columns.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        raise ValueError("no text column to look at")
    flags = df.agg(
        *[
            F.coalesce(F.bool_or(_month_first(quoted(n), separator)), F.lit(False)).alias(f"c{i}")
            for i, n in enumerate(names)
        ]
    )
    pairs = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.when(F.col(f"c{i}"), "date1").otherwise("date0").alias("rule"),
        )
        for i, n in enumerate(names)
    ]
    return flags.select(F.inline(F.array(pairs)))


def _month_first(c: Column, separator: str) -> Column:
    part = [F.split_part(c, F.lit(separator), F.lit(i)) for i in (1, 2, 3)]
    return (
        F.replace(c, F.lit(separator)).rlike(r"^[0-9]+\z")
        & (F.length(part[2]) > 3)
        & (part[0].try_cast("int") < 13)
        & (part[1].try_cast("int") > 12)
    )
