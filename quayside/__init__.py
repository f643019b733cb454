"""quayside: declarative table loading on Spark DataFrames."""

from .functions import UnsupportedColumn, shift_date
from .operators import (
    align,
    as_text,
    coerce_to_target,
    convert,
    split_rejects,
    suggest_rules,
    with_constants,
)
from .plans import LoadReport, copy_table, run, run_params
from .sinks import split_bulk, write_bulk_text
from .sources import list_files, scan_parquet, select_files, source_stats
from .spec import LoadSpec, parse_constants, parse_map, resolve_path
from .streaming import Ledger, ingest_files, ingest_table, read_text_ledger, stream_parquet
from .tables import CatalogTable, JdbcTable

__all__ = [
    "CatalogTable",
    "JdbcTable",
    "Ledger",
    "LoadReport",
    "LoadSpec",
    "UnsupportedColumn",
    "align",
    "as_text",
    "coerce_to_target",
    "convert",
    "copy_table",
    "ingest_files",
    "ingest_table",
    "list_files",
    "parse_constants",
    "parse_map",
    "read_text_ledger",
    "resolve_path",
    "run",
    "run_params",
    "scan_parquet",
    "select_files",
    "shift_date",
    "source_stats",
    "split_bulk",
    "split_rejects",
    "stream_parquet",
    "suggest_rules",
    "with_constants",
    "write_bulk_text",
]
