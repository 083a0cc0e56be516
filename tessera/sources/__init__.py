"""Scans, readers and sinks."""

from tessera.sources.tables import Warehouse, TABLES, read_table
from tessera.sources.files import read_csv, read_pages, save_table, replace_view

__all__ = ["Warehouse", "TABLES", "read_table", "read_csv", "read_pages",
           "save_table", "replace_view"]
