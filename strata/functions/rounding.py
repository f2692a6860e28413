"""Rounding that gives the same digits in every engine.

Rounding a binary double directly is engine specific (``round(1.005, 2)`` differs between
engines). Every rounded value therefore goes through one fixed decimal cast first; the SQL
oracle applies the same cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDING_DECIMAL = "decimal(30,12)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """Half-up rounding on the decimal value (Spark ``round`` semantics), returned as double.
    Values beyond the decimal's range (and NaN / infinity) are rounded as doubles instead of
    failing under ANSI mode."""
    x = _col(c)
    return F.coalesce(F.round(x.try_cast(ROUNDING_DECIMAL), digits).cast("double"), F.round(x, digits))


def round_half_even(c, digits: int) -> Column:
    """Half-even (banker's) rounding on the decimal value, returned as double."""
    x = _col(c)
    return F.coalesce(F.bround(x.try_cast(ROUNDING_DECIMAL), digits).cast("double"), F.bround(x, digits))
