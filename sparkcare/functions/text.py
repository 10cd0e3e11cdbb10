"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suffix_of_name(name: str) -> str:
    """X1+X2 on the driver: lower-case, split on ``_``, last piece (whole name if no ``_``)."""
    return name.lower().split("_")[-1]


def suffix_of(c) -> Column:
    """X1+X2 as a column expression: ``lower`` then last ``_``-separated piece."""
    return F.element_at(F.split(F.lower(_c(c)), "_", -1), -1)


def basename(c) -> Column:
    """Text after the last ``/`` (whole text when there is none)."""
    return F.regexp_extract(_c(c), r"[^/]+$", 0)


def collapse_ws(c) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(_c(c), r"\s+", " ")


def split_ws(c) -> Column:
    """Tokens separated by white space; blanks at both ends are ignored."""
    trimmed = F.regexp_replace(_c(c), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s+"))


def strip_last(c) -> Column:
    """Text without its last character."""
    col = _c(c)
    return F.when(F.length(col) > 0, col.substr(F.lit(1), F.length(col) - 1)).otherwise(col)


def percent_text(share, digits: int = 2) -> Column:
    """``round(share * 100, digits)`` printed with a ``%`` suffix (double printing,
    so 0.473 gives ``47.3%``)."""
    return F.concat(F.round(_c(share).cast("double") * F.lit(100.0), digits).cast("string"), F.lit("%"))


def blank_to_default(c, default: str = "MISSING") -> Column:
    """``coalesce(nullif(x, ''), default)``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def text_or_empty(c) -> Column:
    """The value as text, null as the empty text."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))
