"""Readers: CSV (multi-line aware, explicit schema), tables, versioned tables."""

from tidewater.sources.csv import read_csv, string_schema
from tidewater.sources.tables import list_tables, read_current, read_table, table_exists

__all__ = ["read_csv", "string_schema", "list_tables", "read_current", "read_table", "table_exists"]
