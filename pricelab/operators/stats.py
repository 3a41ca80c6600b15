"""Per-series descriptive statistics and diagnostic tests (AG1-AG3, AG11,
TS1-TS5, TS7, SC8). Inputs are long frames ``(series, dt, <value>)``.

All statistics are grouped aggregates (map-side partial aggregation) or
bounded-look-back windows over the series layout; quantiles are exact, taken
from row positions in value order, never by collecting a group's values.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import pdiv
from ..functions.stats_math import (SparkOps, chi2_sf, chi2_sf_var, kurtosistest_z, norm_ppf, ppf_tail_root, skewtest_z,
                                    z_two_sided)
from ..session import cut_lineage
from .layout import OWN, POS, resolve_mode, series_layout
from .positions import quantiles, value_positions

ALPHA = 0.05
TRADING_DAYS = 252


def simple_returns(df: DataFrame, price: str = "close", series: str = "series", dt: str = "dt",
                   out: str = "returns", mode: str = "auto") -> DataFrame:
    """pct_change of the price per series (first row NULL)."""
    lay = series_layout(df, series, dt, lookback=1, mode=mode)
    w = lay.window()
    prev = F.lag(price, 1).over(w)
    return lay.finish(lay.df.select("*", (pdiv(F.col(price), prev) - 1).alias(out)))


# ---------------------------------------------------------------------------
# AG1 / AG2 / AG3
# ---------------------------------------------------------------------------

def exact_quantiles(df: DataFrame, value: str, probs=(0.25, 0.5, 0.75), series: str = "series",
                    mode: str = "auto") -> DataFrame:
    """Linear-interpolation quantiles (numpy/pandas default) per series (``positions.quantiles``)."""
    return quantiles(df, value, probs, [series], resolve_mode(df, series, mode))


def describe(df: DataFrame, cols: list[str], series: str = "series", digits: int | None = 2) -> DataFrame:
    """AG1: count, mean, std (ddof 1), min, 25/50/75 %, max per (series, column), all
    columns in one pass over a long table."""
    mode = resolve_mode(df, series)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("cell")
    lng = df.select(series, cells).select(series, "cell.column", "cell.x")
    keys = [series, "column"]
    base = lng.groupBy(*keys).agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                  F.min("x").alias("min"), F.max("x").alias("max"))
    q = quantiles(lng, "x", (0.25, 0.5, 0.75), keys, mode)
    at = lambda p: F.max(F.when(F.col("q") == p, F.col("value")))
    out = base.join(q.groupBy(*keys).agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75")), keys, "left")
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    sel = [series, "column", F.col("count")]
    sel += [(F.round(F.col(s).cast("double"), digits) if digits is not None else F.col(s).cast("double")).alias(s)
            for s in stats]
    return out.select(*sel)


def coverage(df: DataFrame, cols: list[str], series: str = "series", dt: str = "dt", price: str = "close",
             by: list[str] | None = None) -> DataFrame:
    """AG2: rows, first/last date, total NULL cells, mean/min/max price."""
    keys = [series] + list(by or [])
    nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in cols), F.lit(0).cast("long"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min(dt).alias("first_dt"),
                                 F.max(dt).alias("last_dt"), nulls.alias("null_cells"),
                                 F.avg(price).alias("mean_price"), F.min(price).alias("min_price"),
                                 F.max(price).alias("max_price"))


def bias_corrected(n, g1, g2):
    """Population skewness/excess kurtosis -> pandas' unbiased G1/G2."""
    G1 = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    G2 = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return G1, G2


def return_stats(df: DataFrame, value: str = "returns", series: str = "series") -> DataFrame:
    """AG3: mean %, std %, annualised volatility %, skewness, kurtosis (unbiased)."""
    x = F.col(value)
    g = df.groupBy(series).agg(F.count(x).alias("n"), F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s"),
                               F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"))
    n = F.col("n").cast("double")
    G1, G2 = bias_corrected(n, F.col("_g1"), F.col("_g2"))
    return g.select(series, "n", (F.col("_m") * 100).alias("mean_pct"), (F.col("_s") * 100).alias("std_pct"),
                    (F.col("_s") * F.lit(float(np.sqrt(TRADING_DAYS))) * 100).alias("annual_vol_pct"),
                    G1.alias("skew"), G2.alias("kurtosis"))


# ---------------------------------------------------------------------------
# AG11 / SC8
# ---------------------------------------------------------------------------

def histogram(df: DataFrame, value: str, bins: int = 80, series: str = "series", density: bool = True) -> DataFrame:
    """AG11: equal-width bins over [min, max] per series, last bin closed;
    density = count / (n * width); empty bins present (zero-filled)."""
    x = F.col(value)
    v = df.where(x.isNotNull() & ~F.isnan(x))
    st = v.groupBy(series).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_n"))
    same = F.col("_hi") == F.col("_lo")
    lo = F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi = F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    st = st.select(series, lo.alias("lo"), hi.alias("hi"), "_n", ((hi - lo) / bins).alias("width"))
    b = F.least(F.floor((x - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = v.join(st, series).groupBy(series, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = st.select(series, "lo", "width", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [series, "bin"], "left").select(
        series, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"), "_n", "width")
    dens = (F.col("count") / (F.col("_n") * F.col("width")))
    return out.select(series, "bin", "bin_lo", "bin_hi", "count",
                      *( [dens.alias("density")] if density else [])).drop("_n", "width")


def normal_pdf_grid(df: DataFrame, value: str, points: int = 100, series: str = "series") -> DataFrame:
    """SC8: N(mean, std) density on ``points`` equally spaced values min..max."""
    x = F.col(value)
    st = df.groupBy(series).agg(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sigma"),
                                F.min(x).alias("lo"), F.max(x).alias("hi"))
    g = st.select(series, "mu", "sigma", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    xv = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    z = (xv - F.col("mu")) / F.col("sigma")
    pdf = F.exp(-z * z / 2) / (F.col("sigma") * F.lit(float(np.sqrt(2 * np.pi))))
    return g.select(series, "i", xv.alias("x"), pdf.alias("pdf"))


# ---------------------------------------------------------------------------
# TS1 / TS2: autocorrelation
# ---------------------------------------------------------------------------

def acf(df: DataFrame, value: str, nlags: int = 30, series: str = "series", dt: str = "dt",
        alpha: float = ALPHA, mode: str = "auto") -> DataFrame:
    """TS1: sample autocorrelation per lag 0..nlags with the Bartlett band
    (statsmodels' ``acf(alpha=...)``): var_1 = 1/n, var_k = (1 + 2*sum_{j<k} rho_j^2)/n.

    One mean aggregate, one window pass for the lagged products, one
    aggregate of nlags+1 sums; the per-lag table (nlags+1 rows per series)
    gets the running band by a window over lags."""
    v = cut_lineage(df.select(series, dt, value).where(F.col(value).isNotNull()))     # the source once, narrow
    mode = resolve_mode(v, series, mode)
    mean = v.groupBy(series).agg(F.avg(value).alias("_mu"), F.count(value).alias("_n"))
    c = v.join(mean, series).withColumn("_d", F.col(value) - F.col("_mu"))
    lay = series_layout(c, series, dt, lookback=nlags, mode=mode)
    w = lay.window()
    keep = [OWN] if lay.halo else []
    prods = lay.finish(lay.df.select(series, "_n", *keep, *[(F.col("_d") * F.lag("_d", k).over(w)).alias(f"_p{k}")
                                                             for k in range(nlags + 1)]))
    sums = prods.groupBy(series).agg(F.first("_n").alias("n"), *[F.sum(f"_p{k}").alias(f"_s{k}")
                                                                 for k in range(nlags + 1)])
    lng = sums.select(series, "n", F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), (F.col(f"_s{k}") / F.col("_s0")).alias("acf"))
        for k in range(nlags + 1)])).alias("r")).select(series, "n", "r.lag", "r.acf")
    from pyspark.sql import Window
    wl = Window.partitionBy(series).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    prev_sq = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(wl), F.lit(0.0))
    var = F.when(F.col("lag") == 0, F.lit(0.0)).when(F.col("lag") == 1, 1 / F.col("n")).otherwise(
        (1 + 2 * prev_sq) / F.col("n"))
    z = z_two_sided(alpha)
    band = F.lit(z) * F.sqrt(var)
    return lng.select(series, F.col("lag").cast("int").alias("lag"), "acf", band.alias("band"),
                      ((F.col("lag") > 0) & (F.abs("acf") > band)).alias("significant"), "n")


def ljung_box(acf_df: DataFrame, lags: int = 10, series: str = "series", alpha: float = ALPHA) -> DataFrame:
    """TS2: Q_m = n(n+2) sum_{k<=m} rho_k^2/(n-k) for m = 1..lags; p from chi2(m)."""
    from pyspark.sql import Window
    a = acf_df.where((F.col("lag") >= 1) & (F.col("lag") <= lags))
    n = F.col("n").cast("double")
    w = Window.partitionBy(series).orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)
    q = n * (n + 2) * F.sum(F.col("acf") * F.col("acf") / (n - F.col("lag"))).over(w)
    out = a.select(series, "lag", q.alias("lb_stat"))
    p = chi2_sf_var(F.col("lb_stat"), F.col("lag"), lags, SparkOps)
    return out.select(series, "lag", "lb_stat", p.alias("lb_pvalue"), (p < alpha).alias("significant"))


# ---------------------------------------------------------------------------
# TS3 / TS4 / TS7
# ---------------------------------------------------------------------------

def normality_tests(df: DataFrame, value: str, series: str = "series", alpha: float = ALPHA) -> DataFrame:
    """TS3 D'Agostino-Pearson K^2 and TS4 Jarque-Bera per series (population
    moments g1, b2; p-values from chi2(2) = exp(-x/2))."""
    x = F.col(value)
    g = df.where(x.isNotNull()).groupBy(series).agg(F.count(x).alias("n"), F.skewness(x).alias("g1"),
                                                    F.kurtosis(x).alias("g2"))
    n = F.col("n").cast("double")
    b2 = F.col("g2") + 3
    z1 = skewtest_z(n, F.col("g1"), SparkOps)
    z2 = kurtosistest_z(n, b2, SparkOps)
    k2 = z1 * z1 + z2 * z2
    jb = n / 6 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4)
    k2p = chi2_sf(k2, 2, SparkOps)
    jbp = chi2_sf(jb, 2, SparkOps)
    return g.select(series, "n", k2.alias("k2_stat"), k2p.alias("k2_pvalue"), (k2p > alpha).alias("k2_normal"),
                    jb.alias("jb_stat"), jbp.alias("jb_pvalue"), (jbp > alpha).alias("jb_normal"))


def residual_verdict(lb: DataFrame, normal: DataFrame, series: str = "series") -> DataFrame:
    """TS7: EXCELLENT (no autocorrelation, both normal) / GOOD (no autocorrelation)
    / CONCERNS."""
    auto = lb.groupBy(series).agg(F.max(F.col("significant").cast("int")).alias("_auto"))
    j = auto.join(normal, series)
    has = F.col("_auto") == 1
    verdict = (F.when(~has & F.col("k2_normal") & F.col("jb_normal"), "EXCELLENT")
               .when(~has, "GOOD").otherwise("CONCERNS"))
    return j.select(series, has.alias("has_autocorrelation"), "k2_normal", "jb_normal", verdict.alias("verdict"))


# ---------------------------------------------------------------------------
# TS5: Q-Q points
# ---------------------------------------------------------------------------

def qq_points(df: DataFrame, value: str, series: str = "series", dt: str = "dt", mode: str = "auto") -> DataFrame:
    """TS5: ordered sample vs normal quantiles at Filliben's medians. ``dt`` tells
    equal samples apart, so a hot value is cut up like others."""
    v = df.select(series, F.col(value).alias("sample"), dt).where(F.col("sample").isNotNull())
    p = value_positions(v, [series], ["sample", dt], resolve_mode(v, series, mode))
    i = F.col(POS) + 1
    n = F.col("_n").cast("double")
    last = F.pow(F.lit(0.5), 1 / n)
    m = (F.when(i == F.col("_n"), last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (n + 0.365)))
    p = p.select(series, i.alias("i"), "sample", m.alias("_p")).withColumn("_r", ppf_tail_root(F.col("_p")))
    return p.select(series, "i", "sample", norm_ppf(F.col("_p"), F.col("_r")).alias("theoretical"))


def qq_line(points: DataFrame, series: str = "series") -> DataFrame:
    """Least-squares line through the Q-Q points and their correlation."""
    return points.groupBy(series).agg(F.regr_slope("sample", "theoretical").alias("slope"),
                                      F.regr_intercept("sample", "theoretical").alias("intercept"),
                                      F.corr("sample", "theoretical").alias("r"))
