"""Catalog and parquet table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (up to three-part) name; blanks around dots are removed."""
    clean = ".".join(part.strip() for part in name.split("."))
    return spark.read.table(clean)


class LazyTables(dict):
    """name -> parquet DataFrame under a folder; a table is opened when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._open = lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        self[name] = self._open(name)
        return self[name]
