"""A corpus pipeline of five operators; counted as part of the ``llm`` subpackage.

Each stage takes what its predecessor kept.  All but the last return the columns of
documents (``n_chars`` follows the text); documents rejected, repeated or leaking a
benchmark item go, repeated lines go, and what is left is packed into batches.  No SQL:
the quality verdict, the classes and the optimal buckets have none; the run is tested
against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcare.llm import decontam, line_dedup, minhash, packing, repetition
from sparkcare.llm.common import stored
from sparkcare.llm.queries import table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return repetition.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line kept once; ``n_chars`` follows the new text."""
    found = line_dedup.dedup_lines(docs)
    own = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*(own.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result but the last written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
