"""Data-quality expectations and the one-row accuracy table (W5: Q1-Q7).

Row-level checks of one table are computed in ONE aggregate pass; schema checks
(column set, column type, column count) read ``df.schema`` on the driver and
start no job.  Each check is also available on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import run_date_text
from .combine import concat_strict


@dataclass
class Expectations:
    """What to check on one table (every field optional)."""
    min_rows: int | None = None
    max_rows: int | None = None
    columns: list[str] | None = None          # exact column set
    unique_column: str | None = None
    type_column: str | None = None
    expected_type: str | None = None          # Spark simple type name, e.g. 'bigint'
    extra: dict = field(default_factory=dict)


def row_count_between(df: DataFrame, min_rows: int | None, max_rows: int | None) -> DataFrame:
    """Q1 (row count): one row with the bounds, the count and whether it is inside."""
    n = F.count(F.lit(1))
    ok = F.lit(True)
    if min_rows is not None:
        ok = ok & (n >= min_rows)
    if max_rows is not None:
        ok = ok & (n <= max_rows)
    return df.agg(F.lit(min_rows).cast("bigint").alias("expected_min_rowcount"),
                  F.lit(max_rows).cast("bigint").alias("expected_max_rowcount"),
                  n.alias("row_count"), ok.alias("meets_rowcount_expectation"))


def column_count_between(df: DataFrame, min_cols: int | None, max_cols: int | None) -> bool:
    """Q1 (column count): driver-side, no job."""
    k = len(df.columns)
    return (min_cols is None or k >= min_cols) and (max_cols is None or k <= max_cols)


def column_set_match(df: DataFrame, expected: list[str], exact: bool = True) -> bool:
    """Q2: the column names equal the expected set (``exact``) or include it."""
    have = set(df.columns)
    return have == set(expected) if exact else set(expected) <= have


def column_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def column_type_is(df: DataFrame, col: str, expected: str) -> tuple[str, str, bool]:
    """Q4: (expected, actual, success) for the type of ``col``."""
    actual = column_type(df, col)
    return expected, actual, actual == expected


def column_unique(df: DataFrame, col: str) -> DataFrame:
    """Q3: values of ``col`` (nulls ignored) are unique: one row with the column, the
    number of values seen more than once and the verdict.  Values are counted with
    a hash aggregate (map-side combine), so a hot value is no single-task group."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")) \
        .where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_values")).select(
        F.lit(col).alias("column"), "duplicate_values", (F.col("duplicate_values") == 0).alias("is_unique"))


def accuracy_table(df: DataFrame, process_name: str, exp: Expectations, run_date=None) -> DataFrame:
    """Q5: one row with every result: date_time, process_name, row-count bounds and
    verdict, all_columns_match, columns_are_unique, column, column_type_expected,
    column_type_actual, column_type_matches.  One aggregate pass over ``df``."""
    n = F.count(F.lit(1))
    aggs = [n.alias("_rows")]
    if exp.unique_column is not None:
        c = exp.unique_column
        aggs.append((F.count_distinct(c) == F.count(c)).alias("_unique"))
    one = df.agg(*aggs)
    ok = F.lit(True)
    if exp.min_rows is not None:
        ok = ok & (F.col("_rows") >= exp.min_rows)
    if exp.max_rows is not None:
        ok = ok & (F.col("_rows") <= exp.max_rows)
    cols_ok = None if exp.columns is None else column_set_match(df, exp.columns)
    t_actual = None if exp.type_column is None else column_type(df, exp.type_column)
    return one.select(
        run_date_text(run_date).alias("date_time"),
        F.lit(process_name).alias("process_name"),
        F.lit(exp.min_rows).cast("bigint").alias("expected_min_rowcount"),
        F.lit(exp.max_rows).cast("bigint").alias("expected_max_rowcount"),
        ok.alias("meets_rowcount_expectation"),
        F.lit(cols_ok).cast("boolean").alias("all_columns_match"),
        (F.col("_unique") if exp.unique_column is not None else F.lit(None).cast("boolean")).alias("columns_are_unique"),
        F.lit(exp.type_column).cast("string").alias("column"),
        F.lit(exp.expected_type).cast("string").alias("column_type_expected"),
        F.lit(t_actual).cast("string").alias("column_type_actual"),
        F.lit(None if t_actual is None else t_actual == exp.expected_type).cast("boolean")
         .alias("column_type_matches"))


def checked_concat(parts: list[DataFrame], path: str, process_name: str, exp: Expectations, run_date=None) -> DataFrame:
    """Q7, the whole flow: extracts of one schema are concatenated, written as Parquet at
    ``path`` and checked as they are read back; the accuracy row is the result."""
    concat_strict(*parts).write.mode("overwrite").parquet(path)
    return accuracy_table(parts[0].sparkSession.read.parquet(path), process_name, exp, run_date)


def run_suite(entities: dict[str, DataFrame], expectations: dict[str, Expectations], run_date=None) -> DataFrame:
    """Q6: the accuracy rows of several entities (one aggregate job per entity,
    unioned into one frame)."""
    rows = [accuracy_table(df, name, expectations[name], run_date) for name, df in entities.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)
