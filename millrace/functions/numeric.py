"""Rounding and ratio rules. All results are plain columns, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT = "decimal(30,10)"


def exact(col: Column) -> Column:
    """A float pinned to ten decimals, so ties and thresholds do not hang on
    the order in which partial sums were merged."""
    return col.cast(EXACT)


def half_up(col: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, returned as double."""
    return F.round(exact(col), digits).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` in double; NULL when the bottom is 0 or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column) -> Column:
    return F.try_divide(F.lit(100.0) * top.cast("double"), bottom.cast("double"))


def count_when(condition: Column) -> Column:
    """How many rows meet the condition; a NULL condition does not count."""
    return F.count_if(condition)


def sum_when(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over rows meeting the condition, 0 over the others."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("decimal(16,4)")))


def null_aware_greatest(floor: float, col: Column) -> Column:
    """GREATEST that stays NULL when the argument is NULL."""
    return F.when(col.isNotNull(), F.greatest(F.lit(floor), col))
