"""sparkcare: health-plan style analytics as plain DataFrame -> DataFrame functions.

Sub-packages
------------
sources    readers: catalog tables, parquet, CSV, report text, JDBC options
sinks      writers: managed table overwrite, refreshed table with comment, CSV,
           parquet, truncate-and-load with a surrogate sequence
functions  column expressions (text, time, encoding)
operators  conform/claims, profiling, combine, quality, default row,
           run-log analytics, range joins, ranking, cost model, text scoring
plans      the proof queries over the driver tables (role mapping + registry)
streaming  incremental ingestion of run-log report files
"""

__version__ = "0.1.0"
