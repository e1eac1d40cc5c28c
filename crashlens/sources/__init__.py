"""Sources and sinks: typed CSV / Parquet readers, staging, CSV sink, test fixture."""

from crashlens.sources.catalog import (
    CrashTables,
    read_csv_inferred,
    read_csv_typed,
    read_table,
    read_tables,
    stage,
)
from crashlens.sources.fixture import load_fixture
from crashlens.sources.sink import write_csv

__all__ = [
    "CrashTables",
    "load_fixture",
    "read_csv_inferred",
    "read_csv_typed",
    "read_table",
    "read_tables",
    "stage",
    "write_csv",
]
