"""Date arithmetic on order timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def at_midnight(day: dt.date | str) -> Column:
    """A day as a zone-free timestamp at its first instant."""
    return F.lit(str(day)).cast("date").cast("timestamp_ntz")


def purchase_window(ts: Column, start: dt.date | str, end: dt.date | str, end_inclusive: bool = False) -> Column:
    """``start <= ts <= end`` on the raw timestamp, so Parquet statistics and
    partition pruning apply. By default the bound is the first instant of the
    last day; ``end_inclusive`` takes the whole last day."""
    lower = ts >= at_midnight(start)
    if end_inclusive:
        after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
        return lower & (ts < at_midnight(after))
    return lower & (ts <= at_midnight(end))


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def lead_days(orders_delivered: str = "delivered_ts", purchase: str = "purchase_ts") -> Column:
    return F.datediff(F.col(orders_delivered), F.col(purchase))


def delay_days() -> Column:
    return F.datediff(F.col("delivered_ts"), F.col("estimated_ts"))


def is_late(grain: str = "timestamp") -> Column:
    """Late delivery, either by exact time or by calendar day."""
    if grain == "day":
        return delay_days() > 0
    return F.col("delivered_ts") > F.col("estimated_ts")


def is_on_time() -> Column:
    return F.col("delivered_ts") <= F.col("estimated_ts")
