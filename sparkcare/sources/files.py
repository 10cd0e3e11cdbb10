"""File, SQL and database sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """S3: CSV with a header.  Give ``schema`` in production; without it the types
    are inferred, which costs an extra pass over the files."""
    reader = spark.read.option("header", header)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_csv_columns(spark: SparkSession, path: str, columns: list[str],
                     schema: StructType | str | None = None, **options) -> DataFrame:
    """Lazy scan of only some columns; the CSV reader prunes the rest."""
    return read_csv(spark, path, schema=schema, **options).select(*columns)


def read_report_lines(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Captured scheduler reports (one or many files, or a folder) as lines.

    Columns: ``value`` (the line) and ``source_file`` (file name, one report per
    job run of the report tool).  ``numbered`` adds ``line_no``, the line's place in its file from
    1 on: a file is read in splits, so lines are counted per split (a table of one row for
    each split), and a line's number is its place in the split plus the lines of the splits
    before it.  Splits and their order are those of the scan, the same when a task runs again."""
    lines = spark.read.text(path)
    named = [F.col("value"), F.col("_metadata.file_name").alias("source_file")]
    if not numbered:
        return lines.select(*named)
    lines = lines.select(*named, F.col("_metadata.file_path").alias("_path"),
                         F.col("_metadata.file_block_start").alias("_split"),
                         F.monotonically_increasing_id().alias("_row"))
    earlier = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("_path", "_split").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    splits = splits.select("_path", "_split", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    # a row for each split; dealt by split, the lines would meet in as few tasks as there are splits
    return lines.join(F.broadcast(splits), ["_path", "_split"]).select(
        "value", "source_file", (F.col("_row") + F.col("_shift") + 1).alias("line_no"))


def jdbc_reader_options(url: str, query: str | None = None, table: str | None = None,
                        user: str | None = None, password: str | None = None,
                        partition_column: str | None = None, lower_bound: int | None = None,
                        upper_bound: int | None = None, num_partitions: int | None = None,
                        fetch_size: int = 10_000, driver: str | None = None) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``.

    A numeric ``partition_column`` with bounds splits the read into
    ``num_partitions`` parallel range queries; Spark cannot combine that with
    ``query``, so the query is wrapped as a derived table in ``dbtable``.
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts["dbtable"] = f"({query}) src" if query is not None else table
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def key_predicates(column: str, parts: int) -> list[str]:
    """``parts`` conditions for a whole-number key of unknown range, a parallel read each: its
    remainders, negative ones included, and the rows without a key.  Every row meets
    exactly one."""
    if parts < 2:
        return ["1 = 1"]
    slots = parts - 1
    return [f"MOD({column}, {slots}) IN ({', '.join(str(x) for x in sorted({i, i - slots} if i else {0}))})"
            for i in range(slots)] + [f"{column} IS NULL"]


def read_jdbc(spark: SparkSession, predicates: list[str] | None = None, **kwargs) -> DataFrame:
    """Database query as a DataFrame (needs the JDBC driver jar on the cluster).

    In parallel with a ``partition_column`` and its bounds, or with ``predicates`` (see
    ``key_predicates``), one partition for each; with neither one task reads everything."""
    options = jdbc_reader_options(**kwargs)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    if "partitionColumn" in options:
        raise ValueError("give either partition_column or predicates")
    url, table = options.pop("url"), options.pop("dbtable", None) or f"({options.pop('query')}) src"
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def run_sql(spark: SparkSession, sql_text: str, **views: DataFrame) -> DataFrame:
    """Run SQL text after registering the given DataFrames as temp views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql_text)
