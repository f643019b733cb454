"""Length limits of text columns, as the destination's schema declares them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Outcome

# Fixed value: where Spark keeps the declared type of a CHAR or VARCHAR column, of catalog and JDBC tables alike.
DECLARED = "__CHAR_VARCHAR_TYPE_STRING"
_SIZED = re.compile(r"(?:var)?char\((\d+)\)", re.I)


def declared_limit(field: T.StructField) -> int | None:
    """Characters a column takes, or None if it does not say."""
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return field.dataType.length
    sized = _SIZED.fullmatch(field.metadata.get(DECLARED, ""))
    return int(sized[1]) if sized else None


def text_limits(rows: T.StructType, target: T.StructType, every: int | None = None) -> dict[str, int]:
    """Column of ``rows`` -> the most characters its destination takes; ``every`` limits all columns, as bulk copies do."""
    declared = {f.name.lower(): declared_limit(f) for f in target}
    found = {}
    for name in rows.names:
        limits = [n for n in (declared.get(name.lower()), every) if n is not None]
        if limits:
            found[name] = min(limits)
    return found


def within(value: Column, limit: int) -> Column:
    """Whether a text fits; trailing blanks beyond the limit do not count, as databases cut them off."""
    return value.isNull() | (F.char_length(F.rtrim(value.cast("string"))) <= limit)


def limit_widths(outcomes: dict[str, Outcome], limits: dict[str, int]) -> dict[str, Outcome]:
    """Outcomes that also fail where a text is longer than its destination takes."""
    limited = {}
    for name, o in outcomes.items():
        if name in limits:
            fits = within(o.value, limits[name])
            o = Outcome(o.value, fits if o.ok is None else o.ok & fits)
        limited[name] = o
    return limited
