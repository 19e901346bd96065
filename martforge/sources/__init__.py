"""Sources: raw CSV tables, warehouse tables and the test-data adapter."""

from .landing import DEFAULT_FILE_MAP, land_all, land_table, row_counts
from .raw import read_csv, read_source, read_sources, read_table, reject_report
from .records import parse_records, read_records
from .star import star_raw
from .text_layer import read_text_table, write_text_table

__all__ = [
    "DEFAULT_FILE_MAP", "land_all", "land_table", "parse_records", "read_csv", "read_records",
    "read_source",
    "read_sources", "read_table", "read_text_table", "reject_report", "row_counts",
    "star_raw", "write_text_table",
]
