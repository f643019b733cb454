"""Column expressions: conversion rules, vendor coercion, date shifts."""

from .rules import Outcome, UnsupportedColumn, apply_rule, null_text, rule_family
from .shift import parse_shifts, shift_date
from .vendor import coerce

__all__ = [
    "Outcome",
    "UnsupportedColumn",
    "apply_rule",
    "coerce",
    "null_text",
    "parse_shifts",
    "rule_family",
    "shift_date",
]
