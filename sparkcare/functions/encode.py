"""Category encoding with a fixed literal map."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_map(c, mapping: dict) -> Column:
    """Look the value up in a literal map; unmapped values (and null) give null,
    as ``Series.apply(dict.get)`` does."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, col)
