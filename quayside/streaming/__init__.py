"""Incremental loading: file ledger and Structured Streaming."""

from .ingest import ingest_files, ingest_table, stream_parquet
from .ledger import Ledger, pending_files, read_text_ledger

__all__ = [
    "Ledger",
    "ingest_files",
    "ingest_table",
    "pending_files",
    "read_text_ledger",
    "stream_parquet",
]
