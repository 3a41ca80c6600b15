"""TS6: augmented Dickey-Fuller test with a constant, lag chosen by AIC.

Lag choice follows the usual procedure: every lag 0..maxlag is fitted on the
same sample (rows with maxlag lags), the AIC-best lag is refitted on the
longest sample it allows, and the statistic is the t-value of the lagged level.
maxlag = min(n // 2 - 2, ceil(12 * (n / 100) ** 0.25)). The p-value is
MacKinnon's (1994) response surface.

One aggregate per series gives all of it. The products of two lagged differences are
a Toeplitz sum but for the ends of the sample: ``C[i+1,j+1] = C[i,j] + (pair before the first
row) - (pair of the last row)``. So sums of each lag with the target, the level and 1 are enough,
3 columns a lag, together with the first and the last maxlag differences of the series.
The rows that a shorter lag adds to the sample are among the first ones, too, so the refit
reads nothing again. The nested systems of the search are one Cholesky factor; solves run in
numpy, batched over series (search) and over series with one chosen lag (refit).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats_math import SparkOps, adf_pvalue
from ..session import cut_lineage
from . import ols
from .layout import OWN, POS, resolve_mode, series_layout, with_positions


def max_lag(n: int) -> int:
    return int(max(0, min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25))))


def _sums(x: DataFrame, value: str, series: str, dt: str, L: int, lag: Column, mode: str) -> DataFrame:
    """Per series: ``lag`` (m), sums over the rows with m lags (``lags``: sum of dy_i, dy_i * dy,
    dy_i * level for i = 1..L) and the ends of the series."""
    mu = x.groupBy(series).agg(F.avg(value).alias("_mu"))
    x = x.join(mu, series).withColumns({"_yc": F.col(value) - F.col("_mu"), "_m": lag})
    lay = series_layout(x, series, dt, lookback=L + 2, mode=mode)
    w = lay.window()
    at = F.col("_at")
    d1 = lay.df.select("*", (F.col(value) - F.lag(value, 1).over(w)).alias("dy"), F.lag("_yc", 1).over(w).alias("yl"))
    d2 = d1.select("*", *[F.lag("dy", i).over(w).alias(f"dy{i}") for i in range(1, L + 1)])
    keep = [OWN] if lay.halo else []
    rows = lay.finish(d2.select(series, "_at", "_n", "_m", "dy", "yl", *[f"dy{i}" for i in range(1, L + 1)], *keep))
    inside = at >= F.col("_m") + 1
    total = lambda c: F.coalesce(F.sum(F.when(inside, c)), F.lit(0.0))
    dy, yl = F.col("dy"), F.col("yl")
    lags = [total(c) for i in range(1, L + 1) for c in (F.col(f"dy{i}"), F.col(f"dy{i}") * dy, F.col(f"dy{i}") * yl)]
    head = F.when((at >= 1) & (at <= F.col("_m")), F.struct(at.alias("at"), dy.alias("dy"), yl.alias("yl")))
    tail = F.when((at >= 1) & (at > F.col("_n") - 1 - F.col("_m")), F.struct((-at).alias("at"), dy.alias("dy")))
    return rows.groupBy(series).agg(
        F.first("_m").alias("m"), F.count(F.when(inside, 1)).alias("nobs"),
        F.array(*[total(c) for c in (dy, yl, yl * yl, dy * yl, dy * dy)]).alias("base"),
        (F.array(*lags) if lags else F.array().cast("array<double>")).alias("lags"),
        F.array_sort(F.collect_list(head)).alias("head"), F.array_sort(F.collect_list(tail)).alias("tail"))


def _systems(m: int, base: np.ndarray, lags: np.ndarray, head: np.ndarray, tail: np.ndarray, nobs: np.ndarray):
    """X'X, X'y, y'y for X = (1, level, dy_1..dy_m), from sums and the first and last m differences
    (``head`` oldest first, ``tail`` newest first)."""
    B, k = len(base), m + 2
    sd, sy, syy, sdy, sdd = base.T
    lags = lags.reshape(B, -1, 3)[:, :m]
    C = np.zeros((B, m + 1, m + 1))
    C[:, 0, 0] = sdd
    C[:, 0, 1:] = C[:, 1:, 0] = lags[:, :, 1]
    first = head[:, ::-1]                       # dy_(T0 - 1 - i)
    for i in range(m):
        C[:, i + 1, 1:] = C[:, i, :-1] + first[:, i, None] * first - tail[:, i, None] * tail
    xtx, xty = np.zeros((B, k, k)), np.zeros((B, k))
    xtx[:, 0, 0], xtx[:, 0, 1], xtx[:, 1, 1] = nobs, sy, syy
    xtx[:, 1, 0] = sy
    xtx[:, 0, 2:] = xtx[:, 2:, 0] = lags[:, :, 0]
    xtx[:, 1, 2:] = xtx[:, 2:, 1] = lags[:, :, 2]
    xtx[:, 2:, 2:] = C[:, 1:, 1:]
    xty[:, 0], xty[:, 1], xty[:, 2:] = sd, sdy, C[:, 0, 1:]
    return xtx, xty, sdd


def nested_ssr(xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray) -> np.ndarray:
    """Residual sums of squares of the regressions on the first 2, 3, ... k columns; NaN where
    they are collinear."""
    B, k = xty.shape
    d = np.sqrt(np.maximum(np.einsum("bii->bi", xtx), 0.0))
    d[d == 0] = 1.0
    A, b = xtx / d[:, :, None] / d[:, None, :], xty / d
    low, z = np.zeros_like(A), np.zeros_like(b)
    bad = np.zeros(B, bool)
    out = np.full((B, k - 1), np.nan)
    left = yty.copy()
    for j in range(k):                          # Cholesky column by column, all series at once
        pivot = A[:, j, j] - (low[:, j, :j] ** 2).sum(1)
        bad |= ~(pivot > 1e-12)
        root = np.sqrt(np.where(bad, 1.0, pivot))
        low[:, j, j] = root
        low[:, j + 1:, j] = (A[:, j + 1:, j] - np.einsum("bik,bk->bi", low[:, j + 1:, :j], low[:, j, :j])) / root[:, None]
        z[:, j] = (b[:, j] - (low[:, j, :j] * z[:, :j]).sum(1)) / root
        left = left - z[:, j] ** 2
        if j:
            out[:, j - 1] = np.where(bad, np.nan, left)
    return out


def _statistics(search: bool, series: str):
    """Chosen lag, sample size and t-value of the level per series."""
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            ms = pdf["m"].to_numpy()
            used, nobs, tau = np.zeros(len(pdf), np.int32), np.zeros(len(pdf), np.int64), np.full(len(pdf), np.nan)
            for m in np.unique(ms):
                same = np.flatnonzero(ms == m)
                step = max(1, (64 << 20) // (8 * 4 * (int(m) + 2) ** 2))
                for lo in range(0, len(same), step):
                    at = same[lo:lo + step]
                    used[at], nobs[at], tau[at] = _of_lag(int(m), pdf.iloc[at], search)
            yield pd.DataFrame({series: pdf[series], "used_lag": used, "nobs": nobs, "adf_stat": tau})
    return run


def _of_lag(m: int, pdf: pd.DataFrame, search: bool):
    n = pdf["nobs"].to_numpy()
    ends = [[np.array([r[c] for r in rows], float) for rows in pdf[col]] for col, c in (("head", "dy"), ("head", "yl"), ("tail", "dy"))]
    whole = np.array([len(h) == m and len(t) == m for h, t in zip(ends[0], ends[2])])
    head, level, tail = (np.stack([x if ok else np.zeros(m) for x, ok in zip(e, whole)]) for e in ends)
    base, lags = np.stack(pdf["base"]).astype(float), np.stack(pdf["lags"]).astype(float)
    xtx, xty, yty = _systems(m, base, lags, head, tail, n)
    used = np.full(len(pdf), m, np.int32)
    if search:
        used[:] = 0
        with np.errstate(all="ignore"):
            ssr = nested_ssr(xtx, xty, yty)
            aic = n[:, None] * (np.log(2 * np.pi) + np.log(ssr / n[:, None]) + 1) + 2 * (np.arange(m + 1) + 2)
        aic = np.where(np.isfinite(aic) & whole[:, None], aic, np.inf)
        used = aic.argmin(1).astype(np.int32)
    nobs, tau = n.copy(), np.full(len(pdf), np.nan)
    for lag in np.unique(used):
        at, k = np.flatnonzero((used == lag) & whole), int(lag) + 2
        A, b, y = xtx[at][:, :k, :k].copy(), xty[at][:, :k].copy(), yty[at].copy()
        for t in range(int(lag) + 1, m + 1):    # rows with `lag` lags that lack m: all within the head
            row = np.concatenate([np.ones((len(at), 1)), level[at][:, t - 1:t], head[at][:, max(t - 1 - lag, 0):t - 1][:, ::-1]], axis=1)
            target = head[at][:, t - 1]
            A += row[:, :, None] * row[:, None, :]
            b += row * target[:, None]
            y += target ** 2
        size = n[at] + (m - lag)
        nobs[at] = size
        beta = ols.solve(A, b)
        with np.errstate(invalid="ignore"):
            rest = ols.ssr(beta, A, b, y)
            good = np.isfinite(beta).all(axis=1) & (size > k) & (rest > 1e-12 * y)     # a perfect fit has no t-value
        if good.any():
            s2 = rest[good] / (size[good] - k)
            with np.errstate(all="ignore"):
                tau[at[good]] = beta[good, 1] / np.sqrt(s2 * np.linalg.inv(A[good])[:, 1, 1])
    return used, nobs, tau


def adf_test(df: DataFrame, value: str, series: str = "series", dt: str = "dt", autolag: bool = True,
             lag: int | None = None, mode: str = "auto", alpha: float = 0.05) -> DataFrame:
    """Per series: adf_stat, p_value, used_lag, nobs, stationary (p < alpha)."""
    # the source once, narrow: positions, mean and sums all read what is written here
    x = cut_lineage(df.select(series, dt, value).where(F.col(value).isNotNull()))
    mode = resolve_mode(x, series, mode)
    x = with_positions(x, series, dt, mode).withColumn("_at", F.col(POS))
    n_max = x.agg(F.max("_n")).first()[0] or 0
    n = F.col("_n")
    most = F.greatest(F.least(F.floor(n / 2) - 2, F.ceil(F.lit(12.0) * F.pow(n / 100.0, 0.25))), F.lit(0)).cast("int")
    L = max_lag(n_max) if autolag else min(int(lag or 0), max_lag(n_max))
    sums = _sums(x, value, series, dt, L, most if autolag else F.least(F.lit(int(lag or 0)), most), mode)
    kind = dict(df.dtypes)[series]
    res = sums.mapInPandas(_statistics(autolag, series), f"{series} {kind}, used_lag int, nobs long, adf_stat double")
    tau = F.when(~F.isnan("adf_stat"), F.col("adf_stat"))
    p = adf_pvalue(tau, SparkOps)
    return res.select(series, tau.alias("adf_stat"), p.alias("p_value"), "used_lag", "nobs", (p < alpha).alias("stationary"))
