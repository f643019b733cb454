"""Date shift chains: ``[-1day][+2month][-3hour][+5minute]``."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"\[([+-]?[0-9]+)(day|month|hour|minute)\]")


class Shift(NamedTuple):
    amount: int
    unit: str


def parse_shifts(chain: str) -> list[Shift]:
    """Steps of a chain in order; anything that is not a step is an error."""
    if _STEP.sub("", chain):
        raise ValueError(f"bad date shift {chain!r}")
    return [Shift(int(n), unit) for n, unit in _STEP.findall(chain)]


def shift_date(c: Column, chain: str | list[Shift]) -> Column:
    """``c`` cut to its day and shifted left to right, as ``yyyy-MM-dd`` text.

    Months clamp to the end of the month.  Hours and minutes count from
    midnight and show only once they cross it.
    """
    shifts = parse_shifts(chain) if isinstance(chain, str) else chain
    at = c.cast("date").cast("timestamp_ntz")
    for amount, unit in shifts:
        at = at + _interval(amount, unit)
    return at.cast("date").cast("string")


def _interval(amount: int, unit: str) -> Column:
    n, none = F.lit(amount), F.lit(0)
    if unit == "month":
        return F.make_ym_interval(none, n)
    if unit == "day":
        return F.make_dt_interval(n)
    if unit == "hour":
        return F.make_dt_interval(none, n)
    return F.make_dt_interval(none, none, n)
