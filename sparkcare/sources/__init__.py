from .tables import read_table, LazyTables, TABLE_NAMES
from .files import read_csv, read_csv_columns, read_report_lines, jdbc_reader_options, key_predicates, read_jdbc, run_sql

__all__ = ["read_table", "LazyTables", "TABLE_NAMES", "read_csv", "read_csv_columns",
           "read_report_lines", "jdbc_reader_options", "key_predicates", "read_jdbc", "run_sql"]
