"""Report number and time formats as column expressions.

Rates stay unrounded doubles everywhere; these functions are applied last.
Rounding is half-even on the exact binary value, so ``rint`` rather than
``round``, and no ``format_string``, whose ties round up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round4(rate: Column) -> Column:
    """Four places, half-even on ``rate * 10000``."""
    return F.rint(rate * 10000) / 10000


def _tenths(value: Column) -> Column:
    """``value`` >= 0 to the nearest tenth, as a whole number of tenths.

    The midpoint test subtracts in an order in which every step is exact
    (the operands are within a factor of two), so ties are true ties.
    """
    low = F.floor(value * 10)
    middle = (2 * low + 1).cast("double")
    side = (value * 16 - middle) + value * 4
    return (F.when(side > 0, low + 1).when(side < 0, low)
            .otherwise(low + low % 2))


def one_decimal(value: Column) -> Column:
    """Fixed-point text with one decimal and a minus sign where negative."""
    tenths = _tenths(F.abs(value))
    return F.concat(F.when(value < 0, "-").otherwise(""),
                    F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def percent(rate: Column) -> Column:
    """``0.1234`` as ``12.3%``."""
    return F.concat(one_decimal(rate * 100), F.lit("%"))


def whole_percent(rate: Column) -> Column:
    """``0.125`` as ``12%``."""
    return F.concat(F.rint(rate * 100).cast("bigint").cast("string"), F.lit("%"))


def points(delta: Column) -> Column:
    """Signed percentage points: ``+1.5pp``."""
    return F.concat(F.when(delta >= 0, "+").otherwise(""), one_decimal(delta * 100), F.lit("pp"))


def utc_millis(moment: Column) -> Column:
    """ISO time in UTC with milliseconds and a trailing ``Z``."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
