"""Row selection over series: PF3 trailing window, PF4 look-back, ST1 union of
sources, ST2 first non-empty source, PF8 valid pairs, PF11 finite only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trailing_window(df: DataFrame, years: float = 3, series: str = "series", dt: str = "dt") -> DataFrame:
    """PF3: keep ``dt >= max(dt) - years*365 days`` per series (365 flat, inclusive).

    The per-series max is a grouped aggregate (one row per series) joined back on
    the series key; AQE broadcasts it when its runtime size is small."""
    days = int(round(years * 365))
    mx = df.groupBy(series).agg(F.max(dt).alias("_max"))
    cutoff = F.col("_max") - F.make_interval(days=F.lit(days)) if _is_ts(df, dt) else F.date_sub("_max", days)
    return df.join(mx, series).where(F.col(dt) >= cutoff).drop("_max")


def _is_ts(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes)[c].startswith("timestamp")


def lookback(df: DataFrame, as_of: str, days: int, dt: str = "dt") -> DataFrame:
    """PF4: ``as_of - days <= dt < as_of``: literal bounds, pushed to the scan."""
    end = F.to_date(F.lit(as_of))
    start = F.date_sub(end, days)
    return df.where((F.col(dt) >= start) & (F.col(dt) < end))


def union_sources(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """ST1: union by name of per-source frames, tagged; missing columns -> NULL."""
    tagged = [f.withColumn(tag, F.lit(name)) for name, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def first_non_empty(df: DataFrame, as_of: str, windows_days=(7, 30, 90, 365, None),
                    series: str = "series", dt: str = "dt") -> DataFrame:
    """ST2: per series, the rows of the first look-back window (7 -> 30 -> 90
    days -> range -> whole history) that holds any row before ``as_of``.

    Windows nest, so each row gets the smallest window index containing it; a
    grouped min per series picks the window; rows with index <= it are kept."""
    end = F.to_date(F.lit(as_of))
    age = F.datediff(end, F.to_date(F.col(dt)))
    prio = F.lit(len(windows_days) - 1)
    for i in reversed(range(len(windows_days))):
        d = windows_days[i]
        if d is not None:
            prio = F.when(age <= d, F.lit(i)).otherwise(prio)
    rows = df.where(F.to_date(F.col(dt)) < end).withColumn("priority", prio)
    best = rows.groupBy(series).agg(F.min("priority").alias("_best"))
    return rows.join(best, series).where(F.col("priority") <= F.col("_best")).drop("_best") \
        .withColumn("priority", F.col("priority").cast("int"))
