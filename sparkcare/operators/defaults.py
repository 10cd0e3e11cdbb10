"""Default-value ("unknown member") row (W4: D1-D6, U4).

The values depend on the column type and the column-name suffix (text after the
last ``_``, lower-cased).  The row is built from typed literals (one-row plan)
and unioned to the frame; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _dec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, CharType, DataType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructType, TimestampNTZType,
                               TimestampType, VarcharType)

from ..functions.text import suffix_of_name

NOT_AVAILABLE = "Not Available"

_FAR, _PAST = _dt.date(9999, 1, 1), _dt.date(1111, 1, 1)

# The default grid.  For each group of types the default of each column-name suffix
# (words of one key share it) and, last, of every other suffix.
GRID: list[tuple[tuple[type[DataType], ...], dict[str, object], object]] = [
    ((StringType, CharType, VarcharType), {"flg yn": "N", "abrv amt cd desc id nm no txt": "~"}, NOT_AVAILABLE),
    ((IntegerType,), {"amt cnt": 0, "cd id no type": -1}, -9999),
    ((LongType,), {"amt cnt": 0, "cd id no": -1}, -9999),
    ((DoubleType,), {"amt cnt": 0.0, "cd id no": -1.0}, -0.9999),
    ((DecimalType,), {"amt cnt": 0.0, "cd id no": -1.1}, -0.99999),
    ((TimestampType, TimestampNTZType), {"ts": _dt.datetime(9999, 1, 1)}, _dt.datetime(1111, 1, 1)),
    ((DateType,), {"dt": _FAR}, _PAST),
]
_BY_TYPE = {kind: ({w: value for words, value in named.items() for w in words.split()}, other)
            for kinds, named, other in GRID for kind in kinds}


def diagnose_object(df: DataFrame) -> StructType:
    """The frame's schema."""
    return df.schema


def replicate_schema(df: DataFrame) -> list[tuple[DataType, str]]:
    """D3: (data type, name suffix) per column."""
    return [(f.dataType, suffix_of_name(f.name)) for f in df.schema.fields]


def default_value(dtype: DataType, suffix: str):
    """The default for one (type, suffix); types outside the grid give 'Not Available'."""
    named, other = _BY_TYPE.get(type(dtype), ({}, NOT_AVAILABLE))
    return named.get(suffix, other)


def assign_default_values(pairs: list[tuple[DataType, str]]) -> tuple:
    """D4 for a whole schema."""
    return tuple(default_value(t, s) for t, s in pairs)


def _literal(value, dtype: DataType):
    """A typed literal; a rule-less type (boolean, float, ...) gets a typed null."""
    if value == NOT_AVAILABLE and not isinstance(dtype, (StringType, CharType, VarcharType)):
        return F.lit(None).cast(dtype)
    if isinstance(dtype, DecimalType):
        q = _dec.Decimal(str(value)).quantize(_dec.Decimal(1).scaleb(-dtype.scale), rounding=_dec.ROUND_HALF_UP)
        return F.lit(str(q)).cast(dtype)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)
    if isinstance(dtype, DateType):
        return F.lit(value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def default_row(spark: SparkSession, schema: StructType) -> DataFrame:
    """D5 (first half): the one-row frame of defaults with exactly ``schema``'s types."""
    values = assign_default_values([(f.dataType, suffix_of_name(f.name)) for f in schema.fields])
    return spark.range(1).select(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(values, schema.fields)])


def connect_row(row: DataFrame, df: DataFrame) -> DataFrame:
    """D5 (second half)/U4: append by position."""
    return df.union(row)


def add_row(df: DataFrame, skip_if_present: bool = False) -> DataFrame:
    """``df`` plus its default row.  Running it twice appends twice unless
    ``skip_if_present`` (then the row is added only when no equal row exists)."""
    row = default_row(df.sparkSession, df.schema)
    if skip_if_present:
        # intersect = left-semi join of df against the one-row frame (a bounded build side)
        row = row.exceptAll(df.intersect(row))
    return connect_row(row, df)
