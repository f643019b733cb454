"""Projections: match source columns to a destination, add constant columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import require_scalar
from ..functions.shift import shift_date
from ..spec import Constant, parse_constants


def align(
    df: DataFrame, target: T.StructType | Iterable[str], order: str = "source"
) -> DataFrame:
    """Keep the columns ``df`` shares with ``target`` (ignoring case), named as there.

    ``order`` is ``"source"`` or ``"target"``.  Columns on one side only are
    left out.
    """
    if order not in ("source", "target"):
        raise ValueError(f"order must be 'source' or 'target', got {order!r}")
    names = target.names if isinstance(target, T.StructType) else list(target)
    spelled = _by_lower_case(names, "destination")
    source = _by_lower_case(df.columns, "source")
    if order == "target":
        kept = [n.lower() for n in names if n.lower() in source]
    else:
        kept = [c.lower() for c in df.columns if c.lower() in spelled]
    if not kept:
        raise ValueError("source and destination share no column")
    for key in kept:
        require_scalar(df.schema[source[key]])
    return df.select([quoted(source[key]).alias(spelled[key]) for key in kept])


def with_constants(
    df: DataFrame, constants: str | Iterable[Constant], run_date: date | None = None
) -> DataFrame:
    """Append constant text columns; ``?date`` stands for the run date."""
    parsed = parse_constants(constants) if isinstance(constants, str) else list(constants)
    present = {c.lower() for c in df.columns}
    clash = [c.name for c in parsed if c.name.lower() in present]
    if clash:
        raise ValueError(f"constant columns already present: {', '.join(clash)}")
    return df.withColumns({c.name: _constant_value(c, run_date) for c in parsed})


def _constant_value(constant: Constant, run_date: date | None) -> Column:
    if not constant.dated:
        return F.lit(constant.text)
    if run_date is None:
        raise ValueError(f"constant {constant.name!r} uses ?date but there is no run date")
    if constant.shifts:
        return shift_date(F.lit(run_date.isoformat()), list(constant.shifts))
    return F.lit(constant.text.replace("?date", run_date.isoformat()))


def quoted(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _by_lower_case(names: Iterable[str], side: str) -> dict[str, str]:
    by_key: dict[str, str] = {}
    for name in names:
        if by_key.setdefault(name.lower(), name) != name:
            raise ValueError(f"{side} columns {by_key[name.lower()]!r} and {name!r} differ only in case")
    return by_key
