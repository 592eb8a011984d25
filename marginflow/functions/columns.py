"""Null-safe arithmetic, whitespace stripping, clipping and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode-aware like Python's str.strip(): Unicode white space (tabs, NBSP, ...)
# plus the ASCII separators U+001C..U+001F, which Python also counts as space.
_EDGE_WS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    return F.regexp_replace(col(c), _EDGE_WS, "")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return col(num) / F.nullif(col(den), F.lit(0))


def clip_lower(c, lo) -> Column:
    """Like pandas ``clip(lower=lo)``: NULL stays NULL (bare greatest would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo) if not isinstance(lo, Column) else lo))


def clip_upper(c, hi) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(hi) if not isinstance(hi, Column) else hi))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (stable output for comparison and export)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def exact_mean(c) -> Column:
    """Mean accumulated as DECIMAL(38, 6), returned as double.

    Order-independent: the same digits whatever the partitioning, unlike a
    double sum. Used for means of money values (prices), whose decimal means
    often end exactly on a rounding tie.
    """
    return F.avg(col(c).cast("decimal(38,6)")).cast("double")
