"""Value coercion for table-to-table copies, by the destination's vendor type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rules import (
    DEFAULT_DECIMAL,
    NumberType,
    Outcome,
    text_of,
    to_byte,
    to_long,
    to_number,
    to_second,
)

# Vendor type names whose text passes through double to decimal.
DECIMAL_TYPES = frozenset(
    {
        "INT2", "INT4", "INT32", "FLOAT4", "FLOAT8", "MONEY", "NUMERIC", "OID", "REGPROC",
        "REGPROCEDURE", "REGOPER", "REGOPERATOR", "REGCLASS", "REGTYPE", "REGROLE",
        "REGNAMESPACE", "REGCONFIG", "REGDICTIONARY", "CARDINAL_NUMBER",
    }
)
SECOND_TYPES = frozenset(("DATETIME", "TIMESTAMP"))


def base_type(vendor_type: str) -> str:
    """``FixedString(16)`` -> ``FIXEDSTRING``."""
    return vendor_type.split("(")[0].strip().upper()


def coerce(
    vendor_type: str,
    c: Column,
    dtype: T.DataType,
    number: NumberType = DEFAULT_DECIMAL,
) -> Outcome:
    """Value of ``c`` as a column of ``vendor_type`` takes it; misfits become NULL.

    INT8 is the exception: NULL and misfits become 0 there.
    """
    name = base_type(vendor_type)
    v = text_of(c)
    # numbers stay numbers, truth values are 0 and 1, every other type is read as its text
    plain, kind = (c, dtype) if isinstance(dtype, T.NumericType) else (v, T.StringType())
    if isinstance(dtype, T.BooleanType):
        plain, kind = c.cast("tinyint"), T.ByteType()
    if name in ("BIT", "TINYINT"):
        value = to_byte(plain, kind).cast("bigint")
    elif name == "INT8":
        if not isinstance(kind, T.IntegralType):
            plain, kind = F.trim(v), T.StringType()
        whole = to_long(plain, kind)
        return Outcome(F.coalesce(whole, F.lit(0)), c.isNull() | whole.isNotNull())
    elif name in DECIMAL_TYPES:
        value = to_number(plain, kind, number)
    elif name in SECOND_TYPES:
        value = to_second(c, dtype)
    else:
        # national strings, geometries and every other type travel as text,
        # which the database driver converts
        return Outcome(v)
    return Outcome(value, c.isNull() | value.isNotNull())
