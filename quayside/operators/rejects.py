"""Split off rows with a value that does not fit its rule."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Outcome
from .align import quoted
from .convert import convert_outcomes, values

FAILED = "failed_columns"


def fits(outcomes: Mapping[str, Outcome]) -> Column:
    """True if every value of the row fits its rule."""
    return reduce(Column.__and__, [o.ok for o in outcomes.values() if o.ok is not None], F.lit(True))


def failed_columns(outcomes: Mapping[str, Outcome]) -> Column:
    """Names of the columns that do not fit.

    Built by ``concat`` and not by filtering an array: a lambda would take the
    whole conversion out of generated code.
    """
    none = F.array().cast("array<string>")
    return F.concat(
        none,
        *[
            F.when(o.ok, none).otherwise(F.array(F.lit(name)))
            for name, o in outcomes.items()
            if o.ok is not None
        ],
    )


def judged(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``df``, evaluated once.

    A filter moves below a projection and repeats its expressions; it cannot
    move below an observation.
    """
    return df.select(*columns).observe("judged", F.count(F.lit(1)).alias("rows"))


def good_rows(df: DataFrame, outcomes: Mapping[str, Outcome]) -> DataFrame:
    """Converted rows without a failing column."""
    if all(o.ok is None for o in outcomes.values()):
        return df.select(values(outcomes))
    rows = judged(df, F.struct(values(outcomes)).alias("row"), fits(outcomes).alias("fits"))
    return rows.where("fits").select("row.*")


def rejected_rows(df: DataFrame, outcomes: Mapping[str, Outcome]) -> DataFrame:
    """Original rows with their failing columns."""
    whole = F.struct(*[quoted(c) for c in df.columns]).alias("row")
    rows = judged(df, whole, failed_columns(outcomes).alias(FAILED))
    return rows.where(F.size(FAILED) > 0).select("row.*", FAILED)


def split_rejects(
    df: DataFrame,
    rules: str | Mapping[str, str],
    target: T.StructType | None = None,
    int96_noon: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: every row of ``df`` is in exactly one of them."""
    outcomes = convert_outcomes(df, rules, target, int96_noon)
    return good_rows(df, outcomes), rejected_rows(df, outcomes)
