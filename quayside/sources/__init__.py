"""Sources: Parquet directories, and tables through ``quayside.tables``."""

from .files import list_files, scan_parquet, select_files, source_stats

__all__ = ["list_files", "scan_parquet", "select_files", "source_stats"]
