"""Text helpers as native column expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import HEADER_ACCENTS_FROM, HEADER_ACCENTS_TO, HEADER_DROPPED, MISSING_AS_TEXT, NA_TOKENS

# Every code point Python's str.strip() removes. Spark's trim() removes only spaces, so
# trimming with this explicit set gives Python semantics without a regex.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: str | Column, dtype: str) -> Column:
    """Cast that yields null instead of failing (ANSI-safe)."""
    return col_of(c).try_cast(dtype)


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace; null stays null."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def na_to_null(c: str | Column) -> Column:
    """Text that a default CSV read would have marked missing becomes null."""
    c = col_of(c)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def as_text(c: str | Column) -> Column:
    """Missing value rendered as text the way ``astype(str)`` does (``nan``)."""
    return F.coalesce(col_of(c), F.lit(MISSING_AS_TEXT))


def normalize_header(c: str | Column) -> Column:
    """Header matching key: strip, lower, fold á é í ó ú, drop ``_`` and spaces."""
    return F.translate(
        F.lower(py_strip(c)),
        HEADER_ACCENTS_FROM + HEADER_DROPPED,
        HEADER_ACCENTS_TO,
    )
