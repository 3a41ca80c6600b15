"""ARIMA(p, d, q) over many series as Spark jobs (FM1-FM4, FM8, FM11, WN18, UD1).

Estimation is Hannan-Rissanen instead of exact MLE (no per-series iterative
solver): (a) a long AR(m) by least squares gives innovation estimates e_t;
(b) least squares of z_t on z_(t-1..t-p) and e_(t-1..t-q) gives phi, theta;
sigma^2 = SSR / n. z = d-th difference of the level, d = 0, 1, 2, ...; a constant is
estimated in both stages for d = 0 only. Estimates differ from the reference library's MLE by sampling error.

Both stages are moment sums (Spark aggregates over lagged columns); only the
(m x m) and ((p+q) x (p+q)) solves run in numpy, batched over series.

A fitted model is a table (``model_table``): coefficients and the state that a forecast
needs (last levels, differences, innovations) per series. ``forecast`` joins it with
requests, a horizon per row, and runs the recursion in JVM expressions.

Rolling origins (FM3) use expanding moments: the sums up to each row give the
refit at every origin in one pass (O(n k^2) instead of n refits); stage (a)
innovations are recursive one-step errors, so no origin sees the future.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import ols
from .layout import OWN, POS, resolve_mode, series_layout

DEFAULT_ORDER = (3, 1, 3)
MIN_HISTORY = 10


def long_ar_order(p: int, q: int) -> int:
    return max(10, p + q + 2)


def _diff(y: str, w, d: int) -> Column:
    """d-th difference: sum_i (-1)^i C(d, i) y_(t-i)."""
    out = None
    for i in range(d + 1):
        term = F.col(y) if i == 0 else F.lag(y, i).over(w)
        term = term * float((-1) ** i * math.comb(d, i))
        out = term if out is None else out + term
    return out


def _levels(d: int) -> list[str]:
    """Columns of the level and its first d - 1 differences, which integration starts from."""
    return [f"_lv{k}" for k in range(d)]


def _source(bars: DataFrame, y: str, series: str, dt: str) -> DataFrame:
    """The three columns that all stages read, materialised: the source is scanned once."""
    return cut_lineage(bars.select(series, dt, y))


def _constant(d: int) -> list[Column]:
    return [F.lit(1.0)] if d == 0 else []


def _stage_frame(bars: DataFrame, y: str, d: int, m: int, series: str, dt: str, mode: str):
    """Own rows with z (differenced level), z lags 1..m and the levels below z."""
    lay = series_layout(bars, series, dt, lookback=d + m, mode=mode)
    w = lay.window()
    z = _diff(y, w, d)
    df = lay.df.select("*", z.alias("z"), *[_diff(y, w, k).alias(n) for k, n in enumerate(_levels(d))])
    df = df.select("*", *[F.lag("z", i).over(w).alias(f"z{i}") for i in range(1, m + 1)])
    keep = [OWN] if lay.halo else []
    pos = [POS] if POS in df.columns else []
    return lay.finish_keep_pos(df.select(series, dt, y, "z", *[f"z{i}" for i in range(1, m + 1)], *_levels(d), *keep, *pos))


def _coef_table(sums: DataFrame, series: str, k: int, names: list[str]) -> DataFrame:
    """Per-series solve of packed sums -> coefficient array, SSR and n."""
    schema = T.StructType([T.StructField(series, T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("ssr", T.DoubleType())])

    def run(it):
        for pdf in it:
            if pdf.empty:
                continue
            S = np.stack([np.asarray(a, dtype=float) for a in pdf["s"]])
            xtx, xty, yty = ols.unpack(S, k)
            b = ols.solve(xtx, xty)
            r = ols.ssr(b, xtx, xty, yty)
            yield pd.DataFrame({series: pdf[series], "n": pdf["n"].astype("int64"),
                                "coef": list(b), "ssr": r})

    return sums.mapInPandas(run, schema)


def arima_fit(bars: DataFrame, order=DEFAULT_ORDER, y: str = "close", series: str = "series", dt: str = "dt",
              m: int | None = None, mode: str = "auto") -> DataFrame:
    """FM1: per series phi[p], theta[q], const, sigma2, llf, aic, bic, n (HR estimates)."""
    bars = _source(bars, y, series, dt)
    mode = resolve_mode(bars, series, mode)
    p, d, q = order
    m = m or long_ar_order(p, q)
    base = _stage_frame(bars, y, d, m, series, dt, mode)
    state = _innovations(base, order, m, series, dt, mode)
    return _stage_b_fit(state, order, series)


def _innovations(base: DataFrame, order, m: int, series: str, dt: str, mode: str) -> DataFrame:
    """Stage (a): long AR(m) on z, innovations e_t = z_t - phi_a . lags; then
    lags of z (1..p) and e (1..q) for stage (b)."""
    p, d, q = order
    regs = _constant(d) + [F.col(f"z{i}") for i in range(1, m + 1)]
    full = base.where(F.col(f"z{m}").isNotNull() & F.col("z").isNotNull())
    prods = ols.cross_products(regs, F.col("z"))
    sums = full.groupBy(series).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in prods]).alias("s"))
    coef = _coef_table(sums, series, len(regs), []).select(series, F.col("coef").alias("_phi_a"))
    pred = sum((F.col("_phi_a")[i] * r for i, r in enumerate(regs)), F.lit(0.0))
    pos = [POS] if POS in base.columns else []
    e = base.join(coef, series).select(series, dt, "z", *[f"z{i}" for i in range(1, max(p, 1) + 1)],
                                       (F.col("z") - pred).alias("e"), *_levels(d), *pos)
    lay = series_layout(e, series, dt, lookback=q, mode=mode)
    w = lay.window()
    out = lay.df.select("*", *[F.lag("e", j).over(w).alias(f"e{j}") for j in range(1, q + 1)])
    return lay.finish(out)


def _stage_b_fit(state: DataFrame, order, series: str) -> DataFrame:
    p, d, q = order
    c = len(_constant(d))
    regs = _constant(d) + [F.col(f"z{i}") for i in range(1, p + 1)] + [F.col(f"e{j}") for j in range(1, q + 1)]
    ok = F.col("z").isNotNull()
    for r in regs:
        ok = ok & r.isNotNull()
    k = len(regs)
    prods = ols.cross_products(regs, F.col("z"))
    sums = state.where(ok).groupBy(series).agg(F.count(F.lit(1)).alias("n"),
                                               F.array(*[F.sum(c) for c in prods]).alias("s"))
    fit = _coef_table(sums, series, k, [])
    n = F.col("n").cast("double")
    sigma2 = F.col("ssr") / n
    llf = -n / 2 * (F.log(2 * math.pi * sigma2) + 1)
    kk = float(k + 1)
    return fit.select(series, "n", F.slice("coef", c + 1, p).alias("phi") if p else F.array().cast("array<double>").alias("phi"),
                      F.slice("coef", c + p + 1, q).alias("theta") if q else F.array().cast("array<double>").alias("theta"),
                      (F.col("coef")[0] if c else F.lit(0.0)).alias("const"),
                      sigma2.alias("sigma2"), llf.alias("llf"), (2 * kk - 2 * llf).alias("aic"),
                      (kk * F.log(n) - 2 * llf).alias("bic"))


def arima_residuals(bars: DataFrame, order=DEFAULT_ORDER, y: str = "close", series: str = "series",
                    dt: str = "dt", m: int | None = None, mode: str = "auto") -> DataFrame:
    """FM4: in-sample residuals eps_t = z_t - phi . z lags - theta . e lags.
    Rows before d + m + max(p, q) have no residual and are dropped."""
    bars = _source(bars, y, series, dt)
    mode = resolve_mode(bars, series, mode)
    p, d, q = order
    m = m or long_ar_order(p, q)
    base = _stage_frame(bars, y, d, m, series, dt, mode)
    state = _innovations(base, order, m, series, dt, mode)
    fit = _stage_b_fit(state, order, series).select(series, "phi", "theta", "const")
    pred = F.col("const")
    for i in range(1, p + 1):
        pred = pred + F.col("phi")[i - 1] * F.col(f"z{i}")
    for j in range(1, q + 1):
        pred = pred + F.col("theta")[j - 1] * F.col(f"e{j}")
    r = state.join(fit, series).select(series, dt, (F.col("z") - pred).alias("residual"))
    return r.where(F.col("residual").isNotNull())


# ---------------------------------------------------------------------------
# Forecasting (FM2, FM11, UD1)
# ---------------------------------------------------------------------------

def recurse_batch(levels: np.ndarray, Z: np.ndarray, E: np.ndarray, PHI: np.ndarray, THETA: np.ndarray,
                  horizons, const=0.0) -> np.ndarray:
    """Vectorised forecast recursion for B rows at once (loop only over steps).

    levels (B, d): the level and its first d - 1 differences; Z (B, p): last diffs, most recent
    first; E (B, q): last innovations; PHI (B, p), THETA (B, q), const a number or (B,).
    Returns (B, len(horizons)) levels."""
    B, p = Z.shape
    q, d = E.shape[1], levels.shape[1]
    hmax = max(horizons)
    zs = np.concatenate([np.zeros((B, hmax)), Z], axis=1)  # column hmax-1 .. : newest first after fill
    es = np.concatenate([np.zeros((B, hmax)), E], axis=1)
    level = levels.astype(float).copy()
    out = {}
    for h in range(1, hmax + 1):
        start = hmax - h + 1  # most recent known value sits at column `start`
        zf = np.zeros(B) + const
        if p:
            zf = zf + np.einsum("bi,bi->b", PHI, zs[:, start:start + p])
        if q:
            zf = zf + np.einsum("bj,bj->b", THETA, es[:, start:start + q])
        zs[:, start - 1] = zf
        es[:, start - 1] = 0.0
        for k in range(d - 1, -1, -1):          # integrate: each level gains the one below
            level[:, k] += zf
            zf = level[:, k]
        out[h] = zf.copy()
    return np.stack([out[h] for h in horizons], axis=1)


MODEL_COLUMNS = ("p int, d int, q int, phi array<double>, theta array<double>, const double, sigma2 double, llf double, aic double, bic double, n long, "
                 "levels array<double>, diffs array<double>, innovations array<double>")


def model_table(bars: DataFrame, order=DEFAULT_ORDER, y: str = "close", series: str = "series", dt: str = "dt",
                m: int | None = None, mode: str = "auto") -> DataFrame:
    """FM1 + state, one row per series: the fit, ``as_of`` and, newest first, what the
    recursion starts from. Latest rows come from a grouped max_by (map-side)."""
    bars = _source(bars, y, series, dt)
    mode = resolve_mode(bars, series, mode)
    p, d, q = order
    m = m or long_ar_order(p, q)
    base = _stage_frame(bars, y, d, m, series, dt, mode)
    state = _innovations(base, order, m, series, dt, mode)
    fit = _stage_b_fit(state, order, series)
    none = F.array().cast("array<double>")
    pack = lambda cols: F.array(*cols) if cols else none
    row = F.struct(F.col(dt).alias("as_of"), pack([F.col(c) for c in _levels(d)]).alias("levels"),
                   pack([F.col("z" if i == 0 else f"z{i}") for i in range(p)]).alias("diffs"),
                   pack([F.col("e" if j == 0 else f"e{j}") for j in range(q)]).alias("innovations"))
    last = state.groupBy(series).agg(F.max_by(row, F.col(dt)).alias("_l"))
    named = [c.strip().split(" ")[0] for c in MODEL_COLUMNS.split(", ")]
    return (fit.join(last, series).select("*", "_l.*").withColumns({"p": F.lit(p), "d": F.lit(d), "q": F.lit(q)})
            .select(series, "as_of", *named))


def forecast(models: DataFrame, requests: DataFrame, series: str = "series", horizon: str = "horizon") -> DataFrame:
    """UD1: ``requests`` (series, horizon, ...) with ``as_of`` and ``forecast`` from the models of their
    series, the level ``horizon`` steps after the model's last bar.

    A NULL horizon asks for one step. NULL comes back where the series has no model, its fit or
    state is incomplete, or the horizon is below 1. Recursion per row: the last
    differences and innovations are short arrays, folded over the steps."""
    h = F.coalesce(F.col(horizon).cast("int"), F.lit(1))
    state = ("phi", "theta", "levels", "diffs", "innovations")
    j = requests.join(models.select(series, *[F.col(c).alias(f"_m_{c}") for c in ("as_of", "const", *state)]), series, "left")
    col = lambda c: F.col(f"_m_{c}")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    ok = (h >= 1) & col("const").isNotNull() & ~F.isnan(col("const"))
    for c in state:
        ok = ok & col(c).isNotNull() & F.forall(col(c), lambda x: x.isNotNull() & ~F.isnan(x))
    start = F.struct(col("diffs").alias("z"), col("innovations").alias("e"), col("levels").alias("l"), F.lit(0.0).alias("out"))

    def step(s, _):
        z = col("const") + dot(col("phi"), s["z"]) + dot(col("theta"), s["e"])
        # levels from the deepest difference up: each gains the one below it
        risen = F.aggregate(F.reverse(s["l"]), F.struct(z.alias("x"), F.slice(s["l"], 1, 0).alias("l")),
                            lambda a, lv: F.struct((lv + a["x"]).alias("x"), F.concat(F.array(lv + a["x"]), a["l"]).alias("l")))
        push = lambda x, old: F.slice(F.concat(F.array(x), old), F.lit(1), F.size(old))
        return F.struct(push(z, s["z"]).alias("z"), push(F.lit(0.0), s["e"]).alias("e"), risen["l"].alias("l"), risen["x"].alias("out"))

    value = F.aggregate(F.sequence(F.lit(1), F.greatest(h, F.lit(1))), start, step, lambda s: s["out"])
    return j.select(*requests.columns, col("as_of").alias("as_of"), F.when(ok, value).alias("forecast"))


def arima_forecast(bars: DataFrame, order=DEFAULT_ORDER, horizons=(1, 2, 5), y: str = "close",
                   series: str = "series", dt: str = "dt", m: int | None = None, mode: str = "auto") -> DataFrame:
    """FM2: fit on the whole history, forecast the given horizons from the last bar."""
    models = model_table(bars, order, y, series, dt, m, mode)
    asked = models.select(series, F.explode(F.array(*[F.lit(int(h)) for h in horizons])).alias("horizon"))
    return forecast(models, asked, series).select(series, "as_of", "horizon", "forecast")


# ---------------------------------------------------------------------------
# FM3 / FM8 / WN18: rolling origins by expanding moments
# ---------------------------------------------------------------------------

def rolling_backtest(bars: DataFrame, order=DEFAULT_ORDER, horizons=(1, 5), ratio: float = 0.8,
                     y: str = "close", series: str = "series", dt: str = "dt", m: int | None = None,
                     min_history: int = MIN_HISTORY, mode: str = "auto") -> DataFrame:
    """FM3: one forecast per test step i and horizon h from the model refitted
    on all rows before test[i] (train + test[:i]); the actual appended after
    each step is the observed bar. Returns ``series, idx, n_split, horizon,
    predicted`` (NULL when the origin's system is singular or history < 10).
    Score with ``evaluate.align`` (JN4 default) + ``forecast_metrics``."""
    bars = _source(bars, y, series, dt)
    mode = resolve_mode(bars, series, mode)
    p, d, q = order
    c = len(_constant(d))
    m = m or long_ar_order(p, q)
    hs = list(horizons)
    base = _stage_frame(bars, y, d, m, series, dt, mode)

    # Stage (a), recursive: coefficients from sums strictly before the row.
    lay_a = series_layout(base, series, dt, lookback=0, mode=mode)
    lags = _constant(d) + [F.col(f"z{i}") for i in range(1, m + 1)]
    ok_a = F.col(f"z{m}").isNotNull() & F.col("z").isNotNull()
    prods = ols.cross_products(lags, F.col("z"))
    exprs = {f"_sa{i}": F.when(ok_a, c) for i, c in enumerate(prods)}
    sa = ols.expanding_sums(lay_a, lay_a.df.select("*", *([] if not lay_a.halo else [])), exprs, upto=-1)
    sa = lay_a.finish_keep_pos(sa.select("*", F.array(*[F.coalesce(F.col(n), F.lit(0.0)) for n in exprs])
                                         .alias("_Sa")).drop(*exprs.keys()))
    e_schema = T.StructType(sa.schema.fields + [T.StructField("e", T.DoubleType())])
    sa = sa.select(*[c for c in sa.columns])

    def innov(it):
        for pdf in it:
            if pdf.empty:
                continue
            S = np.stack([np.asarray(a, dtype=float) for a in pdf["_Sa"]])
            xtx, xty, _ = ols.unpack(S, c + m)
            b = ols.solve(xtx, xty)
            X = np.concatenate([np.ones((len(pdf), c)), pdf[[f"z{i}" for i in range(1, m + 1)]].to_numpy(dtype=float)], axis=1)
            e = pdf["z"].to_numpy(dtype=float) - np.einsum("bi,bi->b", b, X)
            pdf["e"] = e  # NaN when lags missing or too little history
            yield pdf

    with_e = sa.mapInPandas(innov, e_schema).drop("_Sa")
    with_e = with_e.withColumn("e", F.when(~F.isnan("e"), F.col("e")))

    # Stage (b): e lags, expanding sums up to and including the origin row.
    lay_b = series_layout(with_e, series, dt, lookback=max(q, 1), mode=mode)
    w = lay_b.window()
    dfb = lay_b.df.select("*", *[F.lag("e", j).over(w).alias(f"e{j}") for j in range(1, q + 1)],
                          F.row_number().over(w).alias("_rn_local"))
    regs = _constant(d) + [F.col(f"z{i}") for i in range(1, p + 1)] + [F.col(f"e{j}") for j in range(1, q + 1)]
    ok_b = F.col("z").isNotNull()
    for r in regs:
        ok_b = ok_b & r.isNotNull()
    prods_b = ols.cross_products(regs, F.col("z"))
    exprs_b = {f"_sb{i}": F.when(ok_b, c) for i, c in enumerate(prods_b)}
    exprs_b["_nb"] = F.when(ok_b, F.lit(1.0))
    exprs_b["_nh"] = F.lit(1.0)
    sb = ols.expanding_sums(lay_b, dfb, exprs_b, upto=0)
    sb = lay_b.finish(sb.select(
        series, dt, *_levels(d), "z", *[f"z{i}" for i in range(1, p + 1)], "e", *[f"e{j}" for j in range(1, q + 1)],
        F.array(*[F.coalesce(F.col(f"_sb{i}"), F.lit(0.0)) for i in range(len(prods_b))]).alias("_Sb"),
        F.col("_nb").alias("_nb"), F.col("_nh").alias("_nh"), *([OWN] if lay_b.halo else [])))

    # Origins: the last history row before each test step.
    levels = bars.select(series, dt, F.col(y).alias("_y"))
    from .evaluate import time_split
    split = time_split(levels, ratio, series, dt, mode)
    origins = sb.join(split, [series, dt])
    # history size at this row = position + 1; the origin for test step i is
    # the row just before test[i]; its forecast targets test[i + h - 1].
    origins = origins.withColumn("_is_origin", (F.col("split") == "train") & (F.col("idx") == F.col("n_split") - 1)
                                 | (F.col("split") == "test"))
    origins = origins.where(F.col("_is_origin")).select(
        series, dt, *_levels(d), "z", *[f"z{i}" for i in range(1, p)], "e", *[f"e{j}" for j in range(1, q)],
        "_Sb", "_nb", "_nh", "split", "idx", "n_split")
    k = c + p + q
    out_schema = T.StructType([T.StructField(series, T.StringType()), T.StructField("origin_dt", dict(
        (f.name, f.dataType) for f in bars.schema.fields)[dt]), T.StructField("idx", T.LongType()),
        T.StructField("n_split", T.LongType()), T.StructField("horizon", T.IntegerType()),
        T.StructField("predicted", T.DoubleType())])

    def forecast(it):
        for pdf in it:
            if pdf.empty:
                continue
            S = np.stack([np.asarray(a, dtype=float) for a in pdf["_Sb"]])
            xtx, xty, _ = ols.unpack(S, k)
            b = ols.solve(xtx, xty)
            is_train = (pdf["split"] == "train").to_numpy()
            i = np.where(is_train, 0, pdf["idx"].to_numpy(dtype=float) + 1).astype(np.int64)
            nsplit = np.where(is_train, -1, pdf["n_split"].to_numpy(dtype=float)).astype(np.int64)
            keep = is_train | (i < nsplit)
            zc = ["z"] + [f"z{j}" for j in range(1, p)]
            ec = ["e"] + [f"e{j}" for j in range(1, q)]
            Z = pdf[zc].to_numpy(dtype=float) if p else np.zeros((len(pdf), 0))
            E = pdf[ec].to_numpy(dtype=float) if q else np.zeros((len(pdf), 0))
            enough = (pdf["_nh"].to_numpy() >= min_history) & (pdf["_nb"].fillna(0).to_numpy() > k)
            L = pdf[_levels(d)].to_numpy(dtype=float)
            ok = (enough & np.isfinite(b).all(axis=1) & np.isfinite(Z).all(axis=1) & np.isfinite(E).all(axis=1)
                  & np.isfinite(L).all(axis=1))
            b = np.nan_to_num(b)
            F_ = recurse_batch(np.nan_to_num(L), np.nan_to_num(Z), np.nan_to_num(E), b[:, c:c + p], b[:, c + p:], hs, b[:, 0] if c else 0.0)
            F_[~ok] = np.nan
            n = int(keep.sum())
            out = pd.DataFrame({
                series: np.repeat(pdf[series].to_numpy()[keep], len(hs)),
                "origin_dt": np.repeat(pdf[dt].to_numpy()[keep], len(hs)),
                "idx": np.repeat(i[keep], len(hs)),
                "n_split": np.repeat(nsplit[keep], len(hs)),
                "horizon": np.tile(np.asarray(hs, dtype=np.int32), n),
                "predicted": F_[keep].reshape(-1)})
            out["predicted"] = out["predicted"].where(np.isfinite(out["predicted"]), None)
            yield out

    fc = origins.mapInPandas(forecast, out_schema)
    # n_split of the test split for origins that are the last train row
    nt = split.where(F.col("split") == "test").groupBy(series).agg(F.max("n_split").alias("_nt"))
    return fc.join(nt, series).select(series, "origin_dt", "idx",
                                      F.when(F.col("n_split") < 0, F.col("_nt")).otherwise(F.col("n_split"))
                                      .cast("long").alias("n_split"), "horizon", "predicted")


def expanding_ar1(bars: DataFrame, y: str = "close", series: str = "series", dt: str = "dt",
                  mode: str = "auto") -> DataFrame:
    """WN18: expanding-window least squares of z_t on z_(t-1) (no constant) at
    every origin, from running moment sums: phi_t = sum z z_1 / sum z_1^2."""
    mode = resolve_mode(bars, series, mode)
    lay = series_layout(bars, series, dt, lookback=2, mode=mode)
    w = lay.window()
    z = F.col(y) - F.lag(y, 1).over(w)
    df = lay.df.select("*", z.alias("z"))
    df = df.select("*", F.lag("z", 1).over(w).alias("z1"))
    df = lay.finish_keep_pos(df.select(series, dt, "z", "z1", *([OWN, POS] if lay.halo else [])))
    lay2 = series_layout(df, series, dt, lookback=0, mode=mode)
    s = ols.expanding_sums(lay2, lay2.df, {"sxy": F.col("z") * F.col("z1"), "sxx": F.col("z1") * F.col("z1")})
    s = lay2.finish(s)
    return s.select(series, dt, F.col("sxy").alias("sum_xy"), F.col("sxx").alias("sum_xx"),
                    F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).alias("phi"))
