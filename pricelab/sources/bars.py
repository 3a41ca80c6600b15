"""Bar tables: CSV scan (SRC1), resampling of events into OHLCV bars (SRC7),
provider column normalisation (PF1)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_COLUMNS = ("open", "high", "low", "close", "volume")


def read_bars_csv(spark: SparkSession, path: str, series: str | None = None,
                  time_col: str | None = None, time_first: str = "datetime") -> DataFrame:
    """SRC1: header CSV of bars -> ``(series, dt, open, high, low, close, volume)``.

    Time column precedence: explicit ``time_col``; else ``datetime`` then ``Date``
    (``time_first='Date'`` flips the two, as several reference scripts do);
    else the first column. Provider names (``Close_GC=F``, ``Adj Close``) are
    normalised by PF1. The header is read once (a schema lookup, no data
    pass); values are parsed with a declared all-string schema and cast, NaN
    becomes NULL. A ``series``/``ticker`` column is kept when present.
    """
    header = spark.read.option("header", True).csv(path).limit(0).columns
    if time_col is None:
        order = ["datetime", "Date"] if time_first == "datetime" else ["Date", "datetime"]
        time_col = next((c for c in order if c in header), header[0])
    raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])) \
        .option("header", True).csv(path)
    key = next((c for c in header if c.lower() in ("series", "ticker")), None)
    ts = F.coalesce(F.try_to_timestamp(F.col(f"`{time_col}`")),
                    F.try_to_timestamp(F.col(f"`{time_col}`"), F.lit("yyyy-MM-dd HH:mm:ssXXX")))
    base = raw.select((F.col(f"`{key}`") if key else F.lit(series or "default")).alias("series"), ts.alias("dt"),
                      *[F.col(f"`{c}`") for c in header if c not in (time_col, key, "datetime", "Date")])
    norm = normalize_columns(base)
    cols = ["series", "dt"]
    for b in BAR_COLUMNS:
        if b in norm.columns:
            v = F.col(b).cast("double")
            v = F.when(~F.isnan(v), v)  # NaN -> NULL at ingest
            cols.append((v.cast("long") if b == "volume" else v).alias(b))
    return norm.select(*cols)


def resample_ohlcv(df: DataFrame, ts: str, price: str, series: str, interval: str = "1 day",
                   tie: str | None = None, size: str | None = None) -> DataFrame:
    """SRC7: events -> OHLCV bars per (series, bucket).

    open/close are the price at the smallest/largest ``tie`` in the bucket
    (default ``ts``). ``tie`` must be unique and follow time order inside a
    bucket (an event id, a sequence number). A single primitive key keeps the
    aggregation a HashAggregate with map-side partial aggregation, so only one
    row per (series, bucket, partition) crosses the shuffle; a struct key would
    force a sort-based aggregate.
    """
    key = F.col(tie) if tie else F.col(ts)
    unit = interval.strip().lower()
    if unit in ("1 day", "1d", "day"):
        bucket = F.col(ts).cast("date")
    elif unit in ("1 hour", "1h", "hour"):
        bucket = F.date_trunc("hour", F.col(ts))
    elif unit in ("1 minute", "1m", "minute"):
        bucket = F.date_trunc("minute", F.col(ts))
    else:
        bucket = F.window(F.col(ts), _spark_interval(unit)).start
    vol = F.sum(F.col(size)).cast("long") if size else F.count(F.lit(1))
    return (df.groupBy(F.col(series).alias("series"), bucket.alias("dt"))
            .agg(F.min_by(F.col(price), key).alias("open"),
                 F.max(F.col(price)).alias("high"),
                 F.min(F.col(price)).alias("low"),
                 F.max_by(F.col(price), key).alias("close"),
                 vol.alias("volume")))


def _spark_interval(unit: str) -> str:
    m = re.fullmatch(r"(\d+)\s*([a-z]+)", unit)
    if not m:
        raise ValueError(f"bad interval {unit!r}")
    n, u = m.groups()
    names = {"h": "hours", "m": "minutes", "d": "days", "hour": "hours", "hours": "hours",
             "minute": "minutes", "minutes": "minutes", "day": "days", "days": "days"}
    return f"{n} {names[u]}"


# ---------------------------------------------------------------------------
# PF1: provider column normalisation
# ---------------------------------------------------------------------------

def flatten_name(name) -> str:
    """Two-level provider names ('Close', 'GC=F') -> 'Close_GC=F'."""
    if isinstance(name, (tuple, list)):
        return "_".join(str(p) for p in name if str(p))
    return str(name)


def normalize_columns(df: DataFrame) -> DataFrame:
    """PF1: keep columns whose name starts with open/high/low/close/volume
    (case-insensitive, so 'Adj Close' is dropped) and rename each by the first
    of open, high, low, close, volume it contains. A second column for the same
    name (another ticker) raises. Other columns pass through
    only if they are the time index ('dt', 'Date', 'datetime', 'series')."""
    keep = []
    taken = set()
    for c in df.columns:
        lc = c.lower()
        if c in ("series", "dt", "Date", "datetime"):
            keep.append(F.col(f"`{c}`").alias("dt" if c in ("Date", "datetime") else c))
            continue
        if not lc.startswith(BAR_COLUMNS):
            continue
        target = next(b for b in BAR_COLUMNS if b in lc)
        if target in taken:
            raise ValueError(f"more than one column for {target} ({c}): read one ticker at a time")
        taken.add(target)
        keep.append(F.col(f"`{c}`").alias(target))
    return df.select(*keep)
