"""Per-series technical features (WN1-WN10, WN13-WN14, SC1-SC3, PF7, PF12-PF14).

Every family is a list of column expressions over one window spec; Catalyst
merges all frames that share the spec into one Window node behind a single
Exchange + Sort, and chained windows (RSI on delta, std on returns) add Window
nodes but no shuffle. Values follow pandas: ``rolling(k)`` is NULL until k
non-null inputs, ``std`` is ddof=1, divisions follow ``pdiv`` (x/0 = +-inf,
0/0 = NULL), and drop-incomplete keeps infinities.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..functions.expr import pdiv
from ..session import jit_sized
from .ema import BUCKET, ema_lookback, ema_stage
from .layout import SeriesLayout, series_layout

# Fixed values that must equal the reference's feature set.
LAGS = (1, 2, 3, 5, 7, 10, 14, 20)
RETURN_LAGS = (1, 2, 5)
VOLUME_LAGS = (1, 2, 5)
ROLL_WINDOWS = (3, 5, 7, 10, 14, 20, 30, 50)
ROLL_RETURN_WINDOWS = (5, 10, 20)
POSITION_WINDOWS = (10, 20)
EMA_SPANS = (7, 12, 26, 50)
VOLATILITY_WINDOWS = (5, 10, 20, 30)
HL_AVG_WINDOWS = (5, 10, 20)
ATR_WINDOWS = (7, 14)
RSI_WINDOWS = (14, 7)
BB_WINDOW, BB_STD = 20, 2.0
MACD = (12, 26, 9)
TARGETS = {"y_day": 1, "y_week": 5}
BASE_COLUMNS = ("open", "high", "low", "close", "volume")
# The documented 12 most target-correlated features of the "optimized" set.
OPTIMIZED_FEATURES = ("lag_1", "lag_2", "lag_3", "lag_5", "roll_mean_5", "roll_mean_10",
                      "roll_mean_20", "ema_7", "ema_12", "roll_min_5", "roll_max_5", "bb_middle")
# Feature catalog categories: name -> substrings (a feature may fall in several).
CATEGORIES = (
    ("technical", ("rsi", "macd", "bb_")),
    ("lags", ("lag",)),
    ("rolling", ("roll_", "ema_")),
    ("volatility", ("volatility", "atr", "hl_range")),
    ("seasonal", ("day_of", "month", "quarter", "is_")),
    ("price", ("return", "price_", "close_to", "oc_")),
)

MAX_LOOKBACK = 50  # roll_*_50 needs 49 earlier rows; volatility_30 needs 30


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


# ---------------------------------------------------------------------------
# Window registry: every lag / frame aggregate is created once and referenced
# by name, so a frame shared by several features (roll_mean_20 in Bollinger,
# counts behind min_periods) is evaluated once per row.
# ---------------------------------------------------------------------------

_AGG_FNS = {"avg": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}


#: Long frames and the shorter ones that they consist of. Spark goes through every row of a sliding
#: frame again for each row; a frame of 50 is five frames of 10 that it has already.
BLOCKS = {14: 7, 20: 10, 30: 10, 50: 10}


class Windows:
    def __init__(self, w: WindowSpec, late: Windows | None = None):
        self.w = w
        self.late = late                        # window stage over this one: lags of its frames
        self.cols: dict[str, Column] = {}
        self.blocks: dict[str, Column] = {}     # frames of this stage that ``late`` puts together
        self._frames: dict[int, WindowSpec] = {}

    def _add(self, name: str, make) -> Column:
        """Register ``make()`` under ``name`` once (built lazily: py4j calls only
        for new aggregates)."""
        if name not in self.cols:
            self.cols[name] = make()
        return F.col(name)

    def _frame(self, k: int) -> WindowSpec:
        if k not in self._frames:
            self._frames[k] = self.w.rowsBetween(1 - k, 0)
        return self._frames[k]

    def lag(self, c: str, k: int) -> Column:
        return self._add(f"_lag{k}_{c}", lambda: F.lag(c, k).over(self.w))

    def lead(self, c: str, k: int) -> Column:
        return self._add(f"_lead{k}_{c}", lambda: F.lead(c, k).over(self.w))

    def full(self, fn: str, c: str, k: int) -> Column:
        """pandas rolling(k).<fn>() with min_periods=k."""
        if self.late is not None and k in BLOCKS:
            return self._joined(fn, c, k, BLOCKS[k])
        n = self._add(f"_n{k}_{c}", lambda: F.count(F.col(c)).over(self._frame(k)))
        a = self._add(f"_{fn}{k}_{c}", lambda: _AGG_FNS[fn](F.col(c)).over(self._frame(k)))
        return F.when(n == k, a)

    def _parts(self, fn: str, c: str, k: int, b: int) -> list[Column]:
        name = f"_block{b}_{fn}_{c}"
        if name not in self.blocks:
            self.blocks[name] = self.full(fn, c, b)
        return [F.col(name), *[self.late.lag(name, at) for at in range(b, k, b)]]

    def _joined(self, fn: str, c: str, k: int, b: int) -> Column:
        """A frame of ``k`` rows from its blocks of ``b``; NULL unless all blocks are full. Squared
        deviations add up with those of the block means, which cancels nothing."""
        means = self._parts("avg", c, k, b)
        mean = reduce(add, means) / F.lit(float(len(means)))
        if fn == "avg":
            return mean
        parts = self._parts(fn, c, k, b)
        if fn == "std":
            inner = reduce(add, [p * p for p in parts]) * F.lit(b - 1.0)
            outer = reduce(add, [(m - mean) * (m - mean) for m in means]) * F.lit(float(b))
            return F.sqrt((inner + outer) / F.lit(k - 1.0))
        return F.when(mean.isNotNull(), {"min": F.least, "max": F.greatest}[fn](*parts))

    def select(self, df: DataFrame) -> DataFrame:
        out = df.select("*", *[e.alias(n) for n, e in self.cols.items()])
        if not self.blocks:
            return out
        return self.late.select(out.select("*", *[e.alias(n) for n, e in self.blocks.items()]))


def _ln(c: str) -> str:
    return f"_ln_{c}"


def stage1_inputs(df: DataFrame, price: str = "close") -> DataFrame:
    """Column inputs of the lag stage (ln price)."""
    return df.withColumn(_ln(price), F.ln(F.col(price)))


def price_columns(df: DataFrame, W1: Windows, price: str = "close") -> list[Column]:
    """WN3 + SC2 + SC3: return, return_abs, price_change(_pct), hl/oc ratios."""
    c = F.col(price)
    prev = W1.lag(price, 1)
    r = F.col(_ln(price)) - W1.lag(_ln(price), 1)
    cols = [r.alias("return"), F.abs(r).alias("return_abs"), (c - prev).alias("price_change"),
            (pdiv(c, prev) - 1).alias("price_change_pct")]
    if _has(df, "high", "low"):
        cols += [pdiv("high", "low").alias("hl_ratio"), pdiv(c, "high").alias("close_to_high"),
                 pdiv(c, "low").alias("close_to_low")]
    if _has(df, "open"):
        cols += [(c - F.col("open")).alias("oc_change"),
                 pdiv(c - F.col("open"), "open").alias("oc_change_pct")]
    return cols


def lag_columns(df: DataFrame, W1: Windows, price: str = "close", max_lag: int = 20) -> list[Column]:
    """WN1 + WN2: lag_k, return_lag_k = ln c_t - ln c_(t-k), volume_lag_k."""
    cols = [W1.lag(price, k).alias(f"lag_{k}") for k in LAGS if k <= max_lag]
    cols += [(F.col(_ln(price)) - W1.lag(_ln(price), k)).alias(f"return_lag_{k}") for k in RETURN_LAGS]
    if _has(df, "volume"):
        cols += [W1.lag("volume", k).alias(f"volume_lag_{k}") for k in VOLUME_LAGS]
    return cols


def helper_columns(df: DataFrame, W1: Windows, price: str = "close") -> list[Column]:
    """Inputs of chained windows: return, RSI gain/loss (row 0 counts as 0, as
    pandas' where() turns its NaN delta into 0), true range, high-low range."""
    c = F.col(price)
    prev = W1.lag(price, 1)
    delta = F.coalesce(c - prev, F.lit(0.0))
    cols = [(F.col(_ln(price)) - W1.lag(_ln(price), 1)).alias("_ret"),
            F.greatest(delta, F.lit(0.0)).alias("_gain"), F.greatest(-delta, F.lit(0.0)).alias("_loss")]
    if _has(df, "high", "low"):
        # greatest() skips NULLs, so row 0 is high - low (pandas max(axis=1) skips NaN).
        cols += [F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev),
                            F.abs(F.col("low") - prev)).alias("_tr"),
                 (F.col("high") - F.col("low")).alias("_hl")]
    return cols


def rolling_columns(df: DataFrame, W2: Windows, price: str = "close", with_ema: bool = True) -> list[Column]:
    """WN4, WN5, WN7 (+ WN11 names when the EMA columns are present)."""
    cols = []
    for k in ROLL_WINDOWS:
        cols += [W2.full("avg", price, k).alias(f"roll_mean_{k}"), W2.full("std", price, k).alias(f"roll_std_{k}"),
                 W2.full("min", price, k).alias(f"roll_min_{k}"), W2.full("max", price, k).alias(f"roll_max_{k}")]
    for k in ROLL_RETURN_WINDOWS:
        cols += [W2.full("avg", "_ret", k).alias(f"roll_return_mean_{k}"),
                 W2.full("std", "_ret", k).alias(f"roll_return_std_{k}")]
    for k in POSITION_WINDOWS:
        lo, hi = W2.full("min", price, k), W2.full("max", price, k)
        cols.append(pdiv(F.col(price) - lo, hi - lo).alias(f"price_position_{k}"))
    if with_ema:
        cols += [F.col(f"ema_{s}") for s in EMA_SPANS]
    return cols


def volatility_columns(df: DataFrame, W2: Windows, price: str = "close") -> list[Column]:
    """WN6, WN8, WN9, SC2 (hl_range, hl_range_pct). volatility_5/10/20 share
    the frames of roll_return_std_5/10/20 (PD4)."""
    cols = [W2.full("std", "_ret", k).alias(f"volatility_{k}") for k in VOLATILITY_WINDOWS]
    if _has(df, "high", "low"):
        cols += [F.col("_hl").alias("hl_range"), pdiv("_hl", price).alias("hl_range_pct")]
        cols += [W2.full("avg", "_hl", k).alias(f"hl_range_avg_{k}") for k in HL_AVG_WINDOWS]
        cols.append(F.col("_tr").alias("true_range"))
        cols += [W2.full("avg", "_tr", k).alias(f"atr_{k}") for k in ATR_WINDOWS]
    return cols


def rsi_column(W2: Windows, k: int) -> Column:
    """WN10: simple-mean RSI; loss 0 and gain > 0 -> 100; both 0 -> NULL."""
    gain, loss = W2.full("avg", "_gain", k), W2.full("avg", "_loss", k)
    return (F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + pdiv(gain, loss))).alias(f"rsi_{k}")


def bollinger_columns(W2: Windows, price: str = "close", k: int = BB_WINDOW,
                      n_std: float = BB_STD) -> list[Column]:
    """WN13: middle = rolling mean, bands = middle +- n_std * rolling std (ddof 1)."""
    m, s = W2.full("avg", price, k), W2.full("std", price, k)
    up, lo = m + s * n_std, m - s * n_std
    return [up.alias("bb_upper"), m.alias("bb_middle"), lo.alias("bb_lower"),
            pdiv(up - lo, m).alias("bb_width"), pdiv(F.col(price) - lo, up - lo).alias("bb_position")]


def technical_columns(W2: Windows, price: str = "close", with_macd: bool = True) -> list[Column]:
    cols = [rsi_column(W2, k) for k in RSI_WINDOWS]
    if with_macd:
        cols += [F.col("macd"), F.col("macd_signal"), F.col("macd_histogram")]
    return cols + bollinger_columns(W2, price)


def target_columns(W2: Windows, price: str = "close") -> list[Column]:
    """WN14: y_day = close one row ahead, y_week = five rows ahead."""
    return [W2.lead(price, k).alias(n) for n, k in TARGETS.items()]


def two_stage(lay: SeriesLayout, bars: DataFrame, stage1, stage2, price: str = "close",
              keep: list[str] | None = None) -> DataFrame:
    """Run feature families over a layout: ``stage1(W1)`` -> columns needing only
    lags; ``stage2(W2, frame)`` -> columns over frames of stage-1 outputs, long ones put
    together from lags of short ones. All Window nodes share the layout's
    partitioning and ordering (one Exchange)."""
    jit_sized(lay.df.sparkSession)
    w = lay.window()
    base = stage1_inputs(lay.df, price)
    W1 = Windows(w)
    s1_cols = stage1(W1)
    helpers = helper_columns(bars, W1, price)
    f1 = W1.select(base).select(*base.columns, *s1_cols, *helpers)
    W2 = Windows(w, Windows(w))
    s2_cols = stage2(W2, f1)
    f2 = W2.select(f1)
    keep = keep if keep is not None else list(lay.df.columns)
    names1 = [c for c in f1.columns if c not in base.columns and not c.startswith("_")]
    return f2.select(*keep, *names1, *s2_cols)


# ---------------------------------------------------------------------------
# Whole feature table
# ---------------------------------------------------------------------------

def feature_layout(bars: DataFrame, series: str = "series", order="dt", with_ema: bool = True,
                   mode: str = "auto", chunk_rows: int | None = None) -> SeriesLayout:
    lookback = max(MAX_LOOKBACK, ema_lookback(EMA_SPANS, MACD) if with_ema else 0)
    return series_layout(bars, series, order, lookback=lookback, lookahead=max(TARGETS.values()),
                         mode=mode, chunk_rows=chunk_rows)


def create_features(bars: DataFrame, series: str = "series", order="dt", price: str = "close",
                    drop_incomplete: bool = True, targets: bool = True, mode: str = "auto",
                    chunk_rows: int | None = None, layout: SeriesLayout | None = None) -> DataFrame:
    """The full feature table: bars + 96 features (+ y_day, y_week), in the
    reference's column order (price, lag, rolling, volatility, technical,
    seasonal, targets), then drop-incomplete (PF7).

    Plan: one Exchange on the layout keys, the EMA scan on the narrow bars, then three
    Window nodes (lags; frames over them; lags of frames) in the order that the scan left, so neither
    a second shuffle nor a sort of wide rows. All of it is expressions: a caller
    that selects some features gets only their windows computed."""
    lay = layout or feature_layout(bars, series, order, True, mode, chunk_rows)
    first = order if isinstance(order, str) else order[0]
    keep = list(lay.df.columns)
    lay = replace(lay, df=ema_stage(lay, price=price, spans=EMA_SPANS, macd=MACD), order=[BUCKET, *lay.order])

    def s1(W1):
        return price_columns(bars, W1, price) + lag_columns(bars, W1, price)

    def s2(W2, f1):
        cols = (rolling_columns(f1, W2, price) + volatility_columns(f1, W2, price)
                + technical_columns(W2, price) + calendar_columns(first))
        return cols + (target_columns(W2, price) if targets else [])

    out = lay.finish(two_stage(lay, bars, s1, s2, price, keep))
    return _drop_incomplete(out, out.columns) if drop_incomplete else out


def _drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """PF7 on computed columns. The condition also names a column that depends on the
    partition, so the optimizer leaves it above the projection; pushed below, every
    feature would be written out in it and computed twice."""
    here = F.spark_partition_id().alias("_here")
    keep, types = F.col("_here") >= 0, dict(df.dtypes)
    for c in columns:
        x = F.col(f"`{c}`")
        keep = keep & x.isNotNull()
        if types[c] in ("double", "float"):
            keep = keep & ~F.isnan(x)
    return df.select("*", here).where(keep).drop("_here")


#: Features whose presence implies that of all others: the longest window of each input,
#: and every quotient that can be 0/0 by itself. A move among the last 7 closes (rsi_7)
#: means that the wider ranges and deviations below other quotients are not 0 either.
WITNESSES = ("price_change_pct", "return_lag_5", "hl_ratio", "close_to_high", "close_to_low", "oc_change_pct", "hl_range_pct", "volume_lag_1",
             "volume_lag_2", "volume_lag_5", "roll_mean_50", "volatility_30", "hl_range_avg_20", "atr_14", "rsi_7")


def complete_rows(features: DataFrame) -> DataFrame:
    """The rows that drop-incomplete (PF7) keeps, by a few columns only, so that the other
    features need not be computed for a caller that does not select them."""
    decide = [c for c in features.columns if c in WITNESSES or c in TARGETS or c in BASE_COLUMNS or c in ("series", "dt", "seq")]
    return _drop_incomplete(features, decide)


def feature_columns(df: DataFrame, exclude_targets: bool = True,
                    keys: tuple[str, ...] = ("series", "dt", "seq")) -> list[str]:
    """PF12: every column except OHLCV, keys and (optionally) the targets."""
    drop = set(BASE_COLUMNS) | set(keys) | (set(TARGETS) if exclude_targets else set())
    return [c for c in df.columns if c not in drop]


def optimized_features(features: DataFrame, keys=("series", "dt")) -> DataFrame:
    """PF14: the documented 12-feature set + targets. Over ``complete_rows`` only these
    and the columns that decide completeness are computed."""
    return features.select(*keys, *OPTIMIZED_FEATURES, *TARGETS)


def feature_catalog(features: DataFrame, exclude_targets: bool = True) -> DataFrame:
    """PF12 + PF13: per category (substring rules, a feature may fall in
    several) the number of features, the first five names in column order and
    the non-null values they hold over the whole table (one aggregate pass)."""
    names = feature_columns(features, exclude_targets)
    counts = features.agg(*[F.count(F.col(n)).alias(n) for n in names])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"),
                                        F.col(n).alias("n_values")) for i, n in enumerate(names)]))
    long = counts.select(rows.alias("r")).select("r.*")
    rules = F.array(*[F.struct(F.lit(cat).alias("category"), F.array(*[F.lit(x) for x in subs]).alias("subs"))
                      for cat, subs in CATEGORIES])
    hits = F.filter(rules, lambda r: F.exists(r["subs"], lambda x: F.col("name").contains(x)))
    tagged = long.select("*", F.explode(F.transform(hits, lambda r: r["category"])).alias("category"))
    return (tagged.groupBy("category")
            .agg(F.count(F.lit(1)).alias("n_features"),
                 F.sum("n_values").alias("n_values"),
                 F.slice(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))),
                                     lambda x: x["name"]), 1, 5).alias("examples")))
