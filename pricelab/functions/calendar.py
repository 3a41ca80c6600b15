"""SC1: calendar features of the bar timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(dt: str = "dt") -> list[Column]:
    d = F.to_date(F.col(dt))
    dow = F.weekday(d)  # Monday = 0, as pandas dayofweek
    return [
        dow.cast("int").alias("day_of_week"),
        F.month(d).cast("int").alias("month"),
        F.quarter(d).cast("int").alias("quarter"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        (dow >= 5).cast("int").alias("is_weekend"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
    ]


CALENDAR_NAMES = ["day_of_week", "month", "quarter", "day_of_month", "is_weekend",
                  "is_month_start", "is_month_end"]
