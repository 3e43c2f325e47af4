"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_parts(ts: str) -> dict[str, Column]:
    """Weekday (1 = Sunday), date and hour of a timestamp, for ``withColumns``."""
    return {"day_of_week": F.dayofweek(ts), "day": F.to_date(ts), "hour": F.hour(ts)}


def months_back(today: str | Column, months: int, from_month_start: bool = False) -> Column:
    """First moment of a rolling window of months that ends today."""
    day = F.lit(today).cast("date") if isinstance(today, str) else today
    start = F.add_months(day, -months)
    return F.trunc(start, "month") if from_month_start else start


def quarter_hour(ts: str | Column) -> Column:
    """Start of the 15-minute slot a moment falls in."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.window(c, "15 minutes")["start"]


def second_precision(ts: Column) -> Column:
    return F.date_trunc("second", ts)
