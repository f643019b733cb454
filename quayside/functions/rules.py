"""Conversion rules: one rule name, one Catalyst expression.

A rule either yields text (any name containing ``date``) or a typed value.
A text rule that does not fit its input hands the input back; a typed rule
gives NULL.  ``Outcome.ok`` tells the two apart, so rejects can be split off
without evaluating anything a second way.

A column that the scan has already decoded (DATE, TIMESTAMP) skips the textual
rule and is only formatted or cast.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Family keywords in order of precedence, and the text forms that
# the rules accept.  ``\z`` and not ``$``: in Java regex ``$`` also matches
# before a trailing line break.
FAMILIES = ("date", "timestamp", "numeric", "bigint", "datum", "binary", "bit")
INTEGER = r"^[+-]?[0-9]+\z"
# What double takes, but for words: NaN and infinity are no value of a number column.
NUMBER = r"^[\x00-\x20]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|0[xX].*)[fFdD]?[\x00-\x20]*\z"
YEAR_TO_DAY = r"[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])"
ANY_DATE = rf"^{YEAR_TO_DAY}\z"
ANY_SECOND = rf"^{YEAR_TO_DAY} [+-]?[0-9]+:[+-]?[0-9]+:[+-]?[0-9]+(\.[0-9]{{1,9}})?\z"
# Every part within its range in every month and year: the cast takes it as it is.
IN_RANGE_SECOND = (
    r"^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|1[0-9]|2[0-8]) "
    r"([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9](\.[0-9]{1,6})?\z"
)
LONG_MONTHS = ["01", "03", "05", "07", "08", "10", "12"]
# Days since 1970-01-01 that stay within the years 1 to 9999.
FIRST_DAY, LAST_DAY = -719162, 2932896

DEFAULT_DECIMAL = T.DecimalType(38, 10)

NumberType = T.DecimalType | T.DoubleType | T.FloatType
LARGEST_DOUBLE = 1.7976931348623157e308

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INSTANT = (T.TimestampType, T.TimestampNTZType)
_TEMPORAL = (T.DateType, *_INSTANT)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


class Outcome(NamedTuple):
    """Converted value, and whether the input fitted the rule (NULL always fits).

    ``ok`` is None where every input fits.
    """

    value: Column
    ok: Column | None = None


class UnsupportedColumn(TypeError):
    """A nested column was asked to be loaded into a flat table."""


def require_scalar(field: T.StructField) -> None:
    if isinstance(field.dataType, _NESTED):
        raise UnsupportedColumn(
            f"column {field.name!r} is {field.dataType.simpleString()}: "
            "only scalar columns can be loaded"
        )


def rule_family(rule: str) -> str:
    """First family keyword contained in the rule name, else ``text``."""
    return next((f for f in FAMILIES if f in rule), "text")


def text_of(c: Column) -> Column:
    return c.cast("string")


def null_text(c: Column) -> Column:
    """The text ``null`` in any case becomes NULL."""
    return F.when((F.octet_length(c) != 4) | (F.lower(c) != "null"), c)


def apply_rule(
    rule: str,
    c: Column,
    dtype: T.DataType,
    number: NumberType = DEFAULT_DECIMAL,
    int96_noon: bool = False,
) -> Outcome:
    """Expression for ``rule`` over column ``c`` of Spark type ``dtype``.

    ``number`` is the result type of the ``numeric`` family.  ``int96_noon``
    counts the time of day of ``date4`` and ``datum3`` from noon.
    """
    family = rule_family(rule)
    if family == "date":
        return _text_rule(rule, c, dtype, int96_noon)
    if family == "text":
        return Outcome(text_of(c))
    value = _typed_rule(family, rule, c, dtype, number, int96_noon)
    return Outcome(value, c.isNull() | value.isNotNull())


# -- text rules ---------------------------------------------------------------


def _text_rule(rule: str, c: Column, dtype: T.DataType, noon: bool) -> Outcome:
    v = text_of(c)
    if isinstance(dtype, _TEMPORAL):
        return Outcome(_temporal_text(rule, c, dtype, noon))
    if rule == "date7":
        return Outcome(F.replace(F.replace(v, F.lit("'")), F.lit("\0")))
    if rule == "date8":
        flag = F.when(_has(v, "N"), "0").when(_has(v, "Y"), "1").otherwise(v)
        return Outcome(flag)
    if rule == "date4":  # text never holds a decoded timestamp
        return Outcome(v, v.isNull())
    if rule == "date1":
        fits = F.length(v) >= 10
        value = F.concat_ws(
            "-", F.substring(v, 7, 4), F.substring(v, 1, 2), F.substring(v, 4, 2)
        )
    elif rule == "date2":
        fits = F.length(v) >= 2
        value = _to_date_call(F.substring(v, F.lit(1), F.length(v) - 2))
    elif rule == "date3":
        fits = F.length(v) >= 19
        value = F.substring(v, 1, 19)
    elif rule == "date5":
        day = _day_number(c, dtype)
        fits, value = day.isNotNull(), text_of(_from_day_number(day))
    elif rule == "date6":
        second = _leading_seconds(v)
        fits, value = second.isNotNull(), text_of(F.timestamp_seconds(second))
    else:
        return Outcome(v)
    return Outcome(F.when(fits, value).otherwise(v), v.isNull() | fits)


def _temporal_text(rule: str, c: Column, dtype: T.DataType, noon: bool) -> Column:
    day = text_of(c.cast("date"))
    if isinstance(dtype, T.DateType):
        second = F.concat(day, F.lit(" 00:00:00"))
    else:
        # through the string form: formatting a TIMESTAMP_NTZ would pass the
        # session zone and move times that fall into a DST gap
        at = _from_noon(c) if noon and rule == "date4" else c
        second = F.substring(text_of(at), 1, 19)
    if rule in ("date1", "date5"):
        return day
    if rule == "date2":
        return _to_date_call(second)
    if rule in ("date4", "date6"):
        return second
    if rule == "date3" and not isinstance(dtype, T.DateType):
        return second
    return text_of(c)


def _to_date_call(second: Column) -> Column:
    return F.concat(F.lit("to_date('"), second, F.lit("','yyyy-mm-dd hh24:mi:ss')"))


# -- typed rules --------------------------------------------------------------


def _typed_rule(
    family: str,
    rule: str,
    c: Column,
    dtype: T.DataType,
    number: NumberType,
    noon: bool,
) -> Column:
    if family == "numeric":
        return to_number(c, dtype, number)
    if family == "timestamp":
        return to_second(c, dtype)
    if family == "bigint":
        return to_long(c, dtype)
    if family == "binary":
        return low_four_bytes(to_long(c, dtype))
    if family == "bit":
        v = text_of(c)
        return (
            F.when(_has(v, "N"), F.lit(0).cast("tinyint"))
            .when(_has(v, "Y"), F.lit(1).cast("tinyint"))
            .otherwise(to_byte(c, dtype))
        )
    # datum family
    if rule == "datum3":
        if not isinstance(dtype, _TEMPORAL):  # text never holds a decoded timestamp
            return F.lit(None).cast("timestamp_ntz")
        at = c.cast("timestamp_ntz")
        return _from_noon(at) if noon else at
    if isinstance(dtype, _TEMPORAL):
        return c.cast("timestamp_ntz" if rule == "datum4" else "date")
    if rule == "datum2":
        return _from_day_number(_day_number(c, dtype))
    if rule == "datum4":
        return F.timestamp_seconds(_leading_seconds(text_of(c))).cast("timestamp_ntz")
    return to_day(text_of(c))


def to_number(c: Column, dtype: T.DataType, number: NumberType) -> Column:
    """Text goes through double, as far as it is exact; typed numbers do not.

    A floating ``number`` takes the double as it is, without a decimal in between.
    """
    if isinstance(dtype, _TEMPORAL):
        value = _raw_number(c, dtype)
    elif isinstance(dtype, (T.DecimalType, T.DoubleType, *_INTEGRAL)):
        value = c
    else:
        # a cast of text that is no number would cost an exception per value
        v = text_of(c)
        value = F.when(v.rlike(NUMBER), v.try_cast("double"))
    if isinstance(number, T.DecimalType):
        return value.try_cast(number)
    wide = value.cast("double").cast(number)
    return F.when(F.abs(wide) <= LARGEST_DOUBLE, wide)


def to_long(c: Column, dtype: T.DataType) -> Column:
    """Whole text as a signed long: no blanks, no decimals."""
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, _TEMPORAL):
        return _raw_number(c, dtype)
    v = text_of(c)
    return F.when(v.rlike(INTEGER), v.try_cast("bigint"))


def to_byte(c: Column, dtype: T.DataType) -> Column:
    """As ``to_long``, within one byte.

    By range: casting text straight to tinyint costs an exception per misfit.
    """
    n = to_long(c, dtype)
    return F.when(n.between(-128, 127), n.cast("tinyint"))


def to_second(c: Column, dtype: T.DataType) -> Column:
    """First 19 characters as ``yyyy-M-d H:m:s``.

    Parts that run over their range roll on, as JDBC's timestamp escape does:
    30 February is 1 or 2 March, hour 25 is one o'clock of the next day.
    """
    if isinstance(dtype, _TEMPORAL):
        return c.cast("timestamp_ntz")
    v = text_of(c)
    t = F.trim(F.substring(v, 1, 19))
    day, time = F.split_part(t, F.lit(" "), F.lit(1)), F.split_part(t, F.lit(" "), F.lit(2))
    whole, fraction = (F.split_part(time, F.lit("."), F.lit(i)) for i in (1, 2))
    rolled = _rolled_day(day).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), _part(whole, ":", 1), _part(whole, ":", 2),
        _part(whole, ":", 3) + F.concat(F.lit("0."), fraction).try_cast("decimal(9,6)"),
    )
    canonical = _canonical_day(v) & _at(v, 11, " ") & _at(v, 14, ":") & _at(v, 17, ":")
    return F.coalesce(
        F.when(canonical & _digit(v, 19), F.substring(v, 1, 19).try_cast("timestamp_ntz")),
        F.when((F.length(v) >= 19) & t.rlike(IN_RANGE_SECOND), t.try_cast("timestamp_ntz")),
        F.when((F.length(v) >= 19) & t.rlike(ANY_SECOND), rolled),
    )


def to_day(v: Column) -> Column:
    """Text ``yyyy-M-d`` as DATE; a day beyond the month's end rolls on."""
    canonical = (F.length(v) == 10) & _canonical_day(v) & _digit(v, 10)
    return F.coalesce(
        F.when(canonical, v.try_cast("date")), F.when(v.rlike(ANY_DATE), _rolled_day(v))
    )


def low_four_bytes(n: Column) -> Column:
    """Low four bytes of a long, big-endian."""
    return F.substring(F.unhex(F.lpad(F.hex(n), 16, "0")), 5, 4)


# -- pieces -------------------------------------------------------------------


def _has(v: Column, letter: str) -> Column:
    return F.contains(v, F.lit(letter)) | F.contains(v, F.lit(letter.lower()))


def _at(v: Column, position: int, char: str) -> Column:
    return F.substring(v, position, 1) == char


def _digit(v: Column, position: int) -> Column:
    return F.substring(v, position, 1).between("0", "9")


def _canonical_day(v: Column) -> Column:
    """Starts like ``yyyy-MM-dd`` with a day its month has in every year.

    Such texts need no regex, and their cast does not fail: a cast of 30
    February would cost an exception per value.
    """
    month, day = F.substring(v, 6, 2), F.substring(v, 9, 2)
    return (
        _at(v, 5, "-")
        & _at(v, 8, "-")
        & month.between("01", "12")
        & (
            day.between("01", "28")
            | (day.between("29", "30") & (month != "02"))
            | ((day == "31") & month.isin(LONG_MONTHS))
        )
    )


def _part(v: Column, separator: str, index: int) -> Column:
    return F.split_part(v, F.lit(separator), F.lit(index)).try_cast("int")


def _rolled_day(v: Column) -> Column:
    first = F.make_date(_part(v, "-", 1), _part(v, "-", 2), F.lit(1))
    return F.date_add(first, _part(v, "-", 3) - 1)


def _day_number(c: Column, dtype: T.DataType) -> Column:
    """Day count within the supported range, else NULL."""
    n = to_long(c, dtype)
    return F.when(n.between(FIRST_DAY, LAST_DAY), n.cast("int"))


def _from_day_number(day: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), day)


def _leading_seconds(v: Column) -> Column:
    """First ten characters as epoch seconds, else NULL."""
    head = F.substring(v, 1, 10)
    return F.when((F.length(v) >= 10) & head.rlike(INTEGER), head.try_cast("bigint"))


def _from_noon(at: Column) -> Column:
    return at + F.make_dt_interval(F.lit(0), F.lit(12))


def _raw_number(c: Column, dtype: T.DataType) -> Column:
    """The number a file stores for a temporal value: days, or microseconds."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    return F.timestamp_diff("MICROSECOND", epoch, c)
