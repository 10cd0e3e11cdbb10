from .writers import (write_table, refresh_table, write_csv, write_parquet, truncate_and_load,
                      jdbc_writer_options, preview)

__all__ = ["write_table", "refresh_table", "write_csv", "write_parquet", "truncate_and_load",
           "jdbc_writer_options", "preview"]
