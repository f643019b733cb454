"""Row conversion: rules by column name, or coercion by destination type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ..functions.rules import (
    DEFAULT_DECIMAL,
    NumberType,
    Outcome,
    apply_rule,
    null_text,
    require_scalar,
    rule_family,
    text_of,
)
from ..functions.vendor import coerce
from ..spec import match_columns, parse_map
from .align import quoted


def convert(
    df: DataFrame,
    rules: str | Mapping[str, str],
    target: T.StructType | None = None,
    int96_noon: bool = False,
) -> DataFrame:
    """Apply conversion rules; unmapped text ``null`` becomes NULL.

    ``target`` gives the type of ``numeric`` columns: its decimals or floats.
    """
    outcomes = convert_outcomes(df, rules, target, int96_noon)
    return df.select(values(outcomes))


def convert_outcomes(
    df: DataFrame,
    rules: str | Mapping[str, str],
    target: T.StructType | None = None,
    int96_noon: bool = False,
) -> dict[str, Outcome]:
    """Column name -> outcome, in column order."""
    rules = parse_map(rules) if isinstance(rules, str) else rules
    found = match_columns(rules, df.columns, "conversion map")
    by_column = {actual: rules[wanted] for wanted, actual in found.items()}
    outcomes = {}
    for field in df.schema:
        require_scalar(field)
        c, rule = quoted(field.name), by_column.get(field.name)
        if rule is not None:
            outcomes[field.name] = apply_rule(
                rule, c, field.dataType, number_of(target, field.name), int96_noon
            )
        else:
            value = null_text(c) if isinstance(field.dataType, T.StringType) else c
            outcomes[field.name] = Outcome(value)
    return outcomes


def bulk_outcomes(
    df: DataFrame, rules: str | Mapping[str, str], int96_noon: bool = False
) -> dict[str, Outcome]:
    """Column name -> bulk text: only ``date`` rules apply, other mapped columns stay as they are."""
    rules = parse_map(rules) if isinstance(rules, str) else rules
    found = match_columns(rules, df.columns, "conversion map")
    by_column = {actual: rules[wanted] for wanted, actual in found.items()}
    outcomes = {}
    for field in df.schema:
        require_scalar(field)
        c, rule = quoted(field.name), by_column.get(field.name)
        if rule is None:
            outcome = Outcome(null_text(text_of(c)))
        elif rule_family(rule) == "date":
            outcome = apply_rule(rule, c, field.dataType, int96_noon=int96_noon)
        else:
            outcome = Outcome(text_of(c))
        outcomes[field.name] = outcome
    return outcomes


def coerce_to_target(
    df: DataFrame,
    vendor_types: Mapping[str, str],
    target: T.StructType | None = None,
) -> DataFrame:
    """Coerce every column to what its destination's vendor type takes."""
    outcomes = coerce_outcomes(df, vendor_types, target)
    return df.select(values(outcomes))


def coerce_outcomes(
    df: DataFrame,
    vendor_types: Mapping[str, str],
    target: T.StructType | None = None,
) -> dict[str, Outcome]:
    types = {name.lower(): vendor for name, vendor in vendor_types.items()}
    outcomes = {}
    for field in df.schema:
        require_scalar(field)
        if field.name.lower() not in types:
            raise ValueError(f"no destination type for column {field.name!r}")
        outcomes[field.name] = coerce(
            types[field.name.lower()],
            quoted(field.name),
            field.dataType,
            number_of(target, field.name),
        )
    return outcomes


def values(outcomes: Mapping[str, Outcome]) -> list[Column]:
    return [o.value.alias(name) for name, o in outcomes.items()]


def number_of(target: T.StructType | None, name: str) -> NumberType:
    """Type a number column is converted to: the destination's, if that is a decimal or a float."""
    for field in target or ():
        if field.name.lower() == name.lower() and isinstance(field.dataType, NumberType):
            return field.dataType
    return DEFAULT_DECIMAL
