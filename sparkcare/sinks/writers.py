"""Sinks (K1-K6).  Writers are the only actions in the library; everything before
them stays lazy so Spark plans the whole job at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..operators.ranking import with_sequence


def _clean_name(name: str) -> str:
    return ".".join(p.strip() for p in name.split("."))


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, bucket_by: list[str] | None = None,
                num_buckets: int | None = None, sort_by: list[str] | None = None) -> None:
    """K1: managed table (``delta`` where the cluster has it; parquet here).

    ``bucket_by`` + ``num_buckets`` store the table hash-bucketed on the join key so
    later joins on that key read co-located buckets instead of shuffling."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(num_buckets or 64, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(_clean_name(name))


def refresh_table(df: DataFrame, name: str, comment: str | None = None, fmt: str = "parquet") -> DataFrame:
    """K2: a materialized view's full refresh: rebuild the table from ``df`` and set
    its comment.  Returns the table as a DataFrame."""
    spark = df.sparkSession
    n = _clean_name(name)
    write_table(df, n, fmt=fmt, mode="overwrite")
    if comment is not None:
        text = comment.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {n} SET TBLPROPERTIES ('comment' = '{text}')")
    return spark.read.table(n)


def _csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns (struct, array, map) become JSON text; CSV holds only scalars."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", **options) -> None:
    """K3: CSV files with a header (no row-index column)."""
    w = _csv_ready(df).write.mode(mode).option("header", header)
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """K4: parquet files."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def jdbc_writer_options(url: str, table: str, user: str | None = None, password: str | None = None,
                        batch_size: int = 10_000, truncate: bool = True, driver: str | None = None) -> dict:
    """K5 over JDBC: ``mode('overwrite')`` with ``truncate=true`` empties the table
    (TRUNCATE) instead of dropping it, keeping its definition and grants."""
    o = {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": str(truncate).lower()}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if driver is not None:
        o["driver"] = driver
    return o


def truncate_and_load(df: DataFrame, order_cols: list, seq_col: str = "sequence_num",
                      table: str | None = None, jdbc: dict | None = None, start: int = 1) -> DataFrame:
    """K5: replace the target's rows with ``df`` plus a surrogate sequence number
    (``nextval`` per row in ``order_cols`` order).  Returns the loaded frame."""
    loaded = with_sequence(df, order_cols, seq_col, start=start)
    if table is not None:
        write_table(loaded, table, mode="overwrite")
    if jdbc is not None:
        loaded.write.format("jdbc").options(**jdbc).mode("overwrite").save()
    return loaded


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """K6: the first ``n`` rows (for display only; never used inside a transform)."""
    return df.limit(n)
