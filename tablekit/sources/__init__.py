from .tables import read_table, TABLES
from .files import (read_lines, read_whole_files, read_csv_typed, read_csv_inferred,
                    read_csv_strings, range_source, rows_source)
from .sinks import write_csv, write_text, write_keyed_parquet, export_split_rebased

__all__ = ["read_table", "TABLES", "read_lines", "read_whole_files", "read_csv_typed",
           "read_csv_inferred", "read_csv_strings", "range_source", "rows_source",
           "write_csv", "write_text", "write_keyed_parquet", "export_split_rebased"]
