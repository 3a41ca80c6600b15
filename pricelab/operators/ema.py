"""WN11/WN12: exponential moving averages (``adjust=False``) and MACD, on the JVM.

The EMA is a first-order recurrence ``e_t = a*x_t + q*e_(t-1)`` with ``q = 1 - a`` and
``e_0 = x_0``, that is a chain of affine maps, and maps compose. Rows are cut into
buckets of ``B`` consecutive rows of their series. Inside a bucket the composition is a
running sum, ``q^r * sum(a * x_i * q^-i)``, one unbounded-preceding window that Spark
keeps up per row; ``B`` rows keep the powers far from overflow. Across buckets a
row needs the composition of the bucket before: ``q^B`` is below 1e-17, so what came
earlier is lost in rounding and one carry is exact to double precision.

The MACD signal is an EMA of a difference of EMAs. Two cascaded first-order filters
with different poles are a weighted difference of the two filters (partial fractions),
so the signal is an expression over EMAs of the price; equal spans take a second pass.

The first ``EARLY`` rows of a series follow the recurrence step by step: there values are
short decimals that often lie exactly between two roundings, where the order of operations
would show.

In a halo chunk the first halo row stands for the state before it. That seed decays
as ``q^L``; ``ema_halo(span)`` returns the L that pushes it below 1e-17 (979 rows for span 50).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .layout import SeriesLayout

BUCKET = "_bucket"
EARLY = 16
_MAX_EXPONENT = 400.0        # of exp: powers inside a bucket stay below 1e174


def _q(span: int) -> float:
    return (span - 1.0) / (span + 1.0)


def ema_halo(span: int, tol: float = 1e-17) -> int:
    return int(math.ceil(math.log(tol) / math.log(_q(span)))) + 1 if span > 1 else 1


def span_groups(spans) -> list[list[int]]:
    """Spans that can share buckets: large enough for the longest, without overflow for
    the shortest. Ordinary sets (7 to 50) are one group."""
    out: list[list[int]] = []
    for s in sorted(set(spans), reverse=True):
        if out and (s == 1 or -math.log(_q(s)) * ema_halo(out[-1][0]) < _MAX_EXPONENT):
            out[-1].append(s)
        else:
            out.append([s])
    return out


def recurrence(values: Column, span: int) -> Column:
    """EMA after an array of values, one update after the other as pandas writes it."""
    a = F.lit(2.0 / (span + 1.0))
    step = lambda e, x: F.when(e == x, e).otherwise(((1 - a) * e + a * x) / ((1 - a) + a))
    return F.aggregate(F.slice(values, 2, EARLY), F.get(values, F.lit(0)).cast("double"), step)


def _scan(lay: SeriesLayout, df: DataFrame, x: str, spans: list[int], prefix: str) -> DataFrame:
    """``df`` with ``<prefix><span>`` columns and ``BUCKET``, which is ordered like the rows."""
    rows = ema_halo(spans[0])
    keep = [c for c in df.columns if c != BUCKET]
    at = F.row_number().over(Window.partitionBy(*lay.part).orderBy(*lay.order)) - 1
    df = df.select(*keep, at.alias("_at"))
    df = df.select(*keep, F.floor(F.col("_at") / rows).alias(BUCKET), (F.col("_at") % rows).alias("_r"))
    r, first = F.col("_r"), (F.col(BUCKET) == 0) & (F.col("_r") == 0)
    power = {s: F.pow(F.lit(_q(s)), r) for s in spans}
    inside = Window.partitionBy(*lay.part, BUCKET).orderBy(*lay.order).rowsBetween(Window.unboundedPreceding, 0)
    terms = {s: F.when(first, F.col(x)).otherwise(F.lit(2.0 / (s + 1.0)) * F.col(x)) / power[s] for s in spans if s > 1}
    early = (F.col(BUCKET) == 0) & (r < EARLY)
    df = df.select("*", *[F.sum(t).over(inside).alias(f"_sum{s}") for s, t in terms.items()], F.collect_list(F.when(early, F.col(x))).over(inside).alias("_head"))

    def own(s: int) -> Column:
        return F.when(early, recurrence(F.col("_head"), s)).otherwise(power[s] * F.col(f"_sum{s}"))

    df = df.select(*keep, BUCKET, "_r", *[own(s).alias(f"_own{s}") for s in terms])
    before = Window.partitionBy(*lay.part).orderBy(BUCKET, *lay.order).rowsBetween(Window.unboundedPreceding, -1)
    carry = {s: F.last(F.when(r == rows - 1, F.col(f"_own{s}")), ignorenulls=True).over(before) for s in terms}
    df = df.select("*", *[c.alias(f"_carry{s}") for s, c in carry.items()])

    def value(s: int) -> Column:
        if s == 1:
            return F.col(x).cast("double")
        return F.col(f"_own{s}") + power[s] * F.lit(_q(s)) * F.coalesce(F.col(f"_carry{s}"), F.lit(0.0))

    return df.select(*keep, BUCKET, *[value(s).alias(f"{prefix}{s}") for s in spans])


def cascade(slow: str, slow_span: int, fast: str, fast_span: int) -> Column:
    """EMA of span ``fast_span`` of the EMA ``slow``, from both EMAs of the same input."""
    a, q, b, p = 2.0 / (fast_span + 1.0), _q(fast_span), 2.0 / (slow_span + 1.0), _q(slow_span)
    return F.col(fast) * F.lit(b * q / (q - p)) - F.col(slow) * F.lit(a * p / (q - p))


def ema_stage(lay: SeriesLayout, df: DataFrame | None = None, price: str = "close", spans=(7, 12, 26, 50),
              macd: tuple[int, int, int] | None = (12, 26, 9), prefix: str = "ema_") -> DataFrame:
    """``add_ema`` that leaves ``BUCKET`` in: windows ordered by (BUCKET, order) after it
    need no further sort."""
    if lay.halo and lay.lookback < ema_lookback(spans, macd or ()):
        raise ValueError(f"halo layout looks back {lay.lookback} rows; these spans need {ema_lookback(spans, macd or ())}")
    df = lay.df if df is None else df
    keep = list(df.columns)
    for group in span_groups([*spans, *(macd or ())]):
        df = _scan(lay, df, price, group, "_e")
    e = lambda s: F.col(f"_e{s}")
    out = [e(s).alias(f"{prefix}{s}") for s in spans]
    if not macd:
        return df.select(*keep, BUCKET, *out)
    fast, slow, sig = macd
    line = e(fast) - e(slow)
    if sig in (fast, slow):          # a double pole: scan the line itself
        df = _scan(lay, df.withColumn("_line", line), "_line", [sig], "_signal")
        signal = F.col(f"_signal{sig}")
    else:
        signal = cascade(f"_e{fast}", fast, f"_e{sig}", sig) - cascade(f"_e{slow}", slow, f"_e{sig}", sig)
    return (df.select(*keep, BUCKET, *out, line.alias("macd"), signal.alias("macd_signal"))
            .withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")))


def add_ema(lay: SeriesLayout, df: DataFrame | None = None, price: str = "close", spans=(7, 12, 26, 50),
            macd: tuple[int, int, int] | None = (12, 26, 9), prefix: str = "ema_") -> DataFrame:
    """Append ``ema_<span>`` columns (and ``macd, macd_signal, macd_histogram``)."""
    return ema_stage(lay, df, price, spans, macd, prefix).drop(BUCKET)


def ema_lookback(spans=(7, 12, 26, 50), macd=(12, 26, 9)) -> int:
    all_spans = list(spans) + (list(macd) if macd else [])
    # MACD signal is an EMA of an EMA: seeds of both decay, the slower dominates.
    return max(ema_halo(s) for s in all_spans) + (ema_halo(macd[2]) if macd else 0)
