"""Sinks: bulk text files, and tables through ``quayside.tables``."""

from .bulk_text import bulk_lines, split_bulk, write_bulk_text

__all__ = ["bulk_lines", "split_bulk", "write_bulk_text"]
