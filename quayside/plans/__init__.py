"""Whole loads: the envelope around scan, conversion and write."""

from .load import LoadReport, copy_table, run, run_params, transform

__all__ = ["LoadReport", "copy_table", "run", "run_params", "transform"]
