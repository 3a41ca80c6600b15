"""Series layout: how ordered per-series windows are partitioned.

Every window operator here has bounded look-back/look-ahead in rows (lags,
rolling frames, leads). Two layouts give the same rows:

* ``plain``  — ``Window.partitionBy(series)``: one shuffle, one task per
  series. Used when the largest series fits one task.
* ``halo``   — a hot series is cut into row chunks of ``chunk_rows``; each
  chunk also receives copies of the last ``lookback`` rows of the chunk before
  it and the first ``lookahead`` rows of the chunk after it (``_own = false``).
  Windows run on ``(series, _chunk)``, copies are dropped afterwards. No task
  ever holds more than ``chunk_rows + lookback + lookahead`` rows, whatever the
  skew.

The row position needed to cut chunks comes from per-(series, time bucket)
counts prefix-summed over the small count table, never from one global
``row_number`` over a whole series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import conf_int

CHUNK = "_chunk"
OWN = "_own"
POS = "_pos"

MAX_ROWS_PER_TASK_KEY = "pricelab.series.maxRowsPerTask"
CHUNK_ROWS_KEY = "pricelab.series.chunkRows"


@dataclass
class SeriesLayout:
    df: DataFrame
    series: str
    order: list[str]
    part: list[str]
    halo: bool
    lookback: int = 0

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.part).orderBy(*self.order)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop halo copies and layout helpers."""
        if self.halo:
            df = df.where(F.col(OWN))
        return df.drop(CHUNK, OWN, POS)

    def finish_keep_pos(self, df: DataFrame) -> DataFrame:
        if self.halo:
            df = df.where(F.col(OWN))
        return df.drop(CHUNK, OWN)


def resolve_mode(df: DataFrame, series: str = "series", mode: str = "auto", min_chunk: int = 5000) -> str:
    """Pick the layout from one scalar aggregate over the series sizes.

    * largest series above ``pricelab.series.maxRowsPerTask`` -> ``halo``;
    * fewer series than task slots and long enough to cut -> ``halo:<rows>``
      with chunks sized to spread the rows over about twice the slots;
    * otherwise ``plain``.
    Operators resolve once and pass the result to every layout they build."""
    if mode != "auto":
        return mode
    spark = df.sparkSession
    limit = conf_int(spark, MAX_ROWS_PER_TASK_KEY, 1_000_000)
    r = df.groupBy(series).count().agg(F.max("count").alias("m"), F.count(F.lit(1)).alias("k"),
                                       F.sum("count").alias("t")).first()
    biggest, n_series, total = (r["m"] or 0), (r["k"] or 0), (r["t"] or 0)
    if biggest > limit:
        return "halo"
    slots = spark.sparkContext.defaultParallelism
    if n_series < slots and biggest >= 2 * min_chunk:
        return f"halo:{max(min_chunk, -(-total // (2 * slots)))}"
    return "plain"


def _order_number(c: str, dtype: str) -> Column:
    """A numeric, order-preserving image of the first order column."""
    if dtype == "date":
        return F.unix_date(F.col(c)).cast("long")
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    return F.col(c).cast("double")


def series_layout(df: DataFrame, series: str = "series", order="dt", lookback: int = 0,
                  lookahead: int = 0, mode: str = "auto", chunk_rows: int | None = None) -> SeriesLayout:
    """Lay ``df`` out for ordered windows per ``series`` (see module doc).

    ``mode='auto'`` runs one small aggregate (largest series row count, a
    scalar) to pick plain or halo; ``'plain'``/``'halo'`` force a layout.
    ``order`` must be unique within a series.
    """
    spark = df.sparkSession
    order = [order] if isinstance(order, str) else list(order)
    mode = resolve_mode(df, series, mode)
    if mode == "plain":
        return SeriesLayout(df, series, order, [series], False)
    hint = int(mode.split(":")[1]) if ":" in mode else None

    c_rows = chunk_rows or (max(hint, 4 * (lookback + lookahead)) if hint else None) \
        or conf_int(spark, CHUNK_ROWS_KEY, 250_000)
    if lookback > c_rows or lookahead > c_rows:
        raise ValueError("chunk_rows must cover lookback and lookahead")
    base_cols = [c for c in df.columns if c != POS]
    if POS in df.columns:
        # Positions carried over from an earlier layout of the same rows: reuse.
        indexed = df
    else:
        indexed = _index_positions(df, series, order, c_rows)

    # 4. chunk and halo copies (narrow: no shuffle until the windows run).
    chunk = F.floor(F.col(POS) / c_rows).cast("long")
    r = F.col(POS) % c_rows
    targets = F.array(F.struct(chunk.alias("c"), F.lit(True).alias("o")))
    if lookback:
        targets = F.when(r >= c_rows - lookback,
                         F.array_union(targets, F.array(F.struct((chunk + 1).alias("c"), F.lit(False).alias("o"))))
                         ).otherwise(targets)
    if lookahead:
        targets = F.when((r < lookahead) & (chunk > 0),
                         F.array_union(targets, F.array(F.struct((chunk - 1).alias("c"), F.lit(False).alias("o"))))
                         ).otherwise(targets)
    out = (indexed.select("*", F.explode(targets).alias("_t"))
           .select(*base_cols, POS, F.col("_t.c").alias(CHUNK), F.col("_t.o").alias(OWN)))
    return SeriesLayout(out, series, order, [series, CHUNK], True, lookback)


def _index_positions(df: DataFrame, series: str, order: list[str], c_rows: int) -> DataFrame:
    """Add ``_pos`` without a whole-series sort (steps 1-3)."""
    dtype = dict(df.dtypes)[order[0]]
    t = _order_number(order[0], dtype)

    # 1. per-series span and count (one row per series).
    stats = df.groupBy(series).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"),
                                   F.max(t).alias("_t1"))
    # time-bucket width so a bucket holds about chunk_rows/4 rows on average.
    width = F.greatest(F.lit(1.0), (F.col("_t1") - F.col("_t0") + 1) * F.lit(c_rows / 4.0) / F.col("_n"))
    stats = stats.select(series, "_t0", width.alias("_w"))
    with_tb = df.join(stats, series).withColumn(
        "_tb", F.floor((t - F.col("_t0")) / F.col("_w")).cast("long")).drop("_t0", "_w")

    # 2. rows per (series, bucket), prefix-summed within the series: small table.
    counts = with_tb.groupBy(series, "_tb").agg(F.count(F.lit(1)).alias("_cnt"))
    cw = Window.partitionBy(series).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(series, "_tb", F.coalesce(F.sum("_cnt").over(cw), F.lit(0)).alias("_off"))

    # 3. global position = bucket offset + rank inside the bucket.
    inner = Window.partitionBy(series, "_tb").orderBy(*order)
    pos = (F.col("_off") + F.row_number().over(inner) - 1).alias(POS)
    return with_tb.join(offsets, [series, "_tb"]).select(*df.columns, pos)


def with_positions(df: DataFrame, series: str = "series", order="dt", mode: str = "auto",
                   chunk_rows: int | None = None) -> DataFrame:
    """Add ``_pos`` (0-based row position in its series) and ``_n`` (series size).

    ``plain``: ``row_number``/``count`` over the series window (one shuffle).
    ``halo``/large series: positions from per-(series, time bucket) counts
    prefix-summed (see ``series_layout``), sizes from a grouped count, so no task
    sorts a whole hot series."""
    order = [order] if isinstance(order, str) else list(order)
    mode = resolve_mode(df, series, mode)
    if mode == "plain":
        w = Window.partitionBy(series).orderBy(*order)
        return df.select("*", (F.row_number().over(w) - 1).alias(POS),
                         F.count(F.lit(1)).over(Window.partitionBy(series)).alias("_n"))
    lay = series_layout(df, series, order, 0, 0, mode=mode, chunk_rows=chunk_rows)
    idx = lay.finish_keep_pos(lay.df)
    sizes = df.groupBy(series).agg(F.count(F.lit(1)).alias("_n"))
    return idx.join(sizes, series)
