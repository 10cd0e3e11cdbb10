"""Vertical concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


class SchemaMismatch(ValueError):
    pass


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name, missing columns null
    (``pd.concat``).  Column order: first frame's, then new ones as they appear."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_strict(*frames: DataFrame) -> DataFrame:
    """Rows of frames with identical schemas (names, order and types), else
    ``SchemaMismatch`` (``pl.concat``).  The check is on the driver: no job."""
    first = frames[0].schema
    for i, f in enumerate(frames[1:], start=1):
        a = [(x.name, x.dataType) for x in first.fields]
        b = [(x.name, x.dataType) for x in f.schema.fields]
        if a != b:
            raise SchemaMismatch(f"frame {i} schema {b} differs from frame 0 schema {a}")
    return reduce(lambda a, b: a.union(b), frames)
