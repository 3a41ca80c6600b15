"""Model queries: ARIMA (FM1-FM4, FM8, FM11, WN18, UD1), ADF (TS6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats_math as sm
from ..operators import arima as ar
from ..operators import evaluate as ev
from ..operators import stats as st
from ..operators.stationarity import adf_test
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from .registry import query, round_df

_Z = """
z AS (SELECT series, dt, close - lag(close) OVER (PARTITION BY series ORDER BY dt) AS z FROM bars_daily),
zz AS (SELECT series, dt, z, lag(z) OVER (PARTITION BY series ORDER BY dt) AS z1 FROM z)"""


def _bars(spark, sf):
    return fixtures.bars_daily(spark, sf)


# FM1 special case ARIMA(1,1,0): least squares without constant has a closed form.
@query("arima_fit_ar1", with_ctes(f"""
WITH {_Z.strip()},
s AS (SELECT series, count(*) AS n, sum(z * z1) AS sxy, sum(z1 * z1) AS sxx, sum(z * z) AS syy
  FROM zz WHERE z IS NOT NULL AND z1 IS NOT NULL GROUP BY series),
f AS (SELECT series, n, sxy / sxx AS phi, (syy - 2 * (sxy / sxx) * sxy + (sxy / sxx) * (sxy / sxx) * sxx) / n AS sigma2 FROM s),
l AS (SELECT *, -CAST(n AS DOUBLE) / 2 * (ln(2 * pi() * sigma2) + 1) AS llf FROM f)
SELECT series, n, round(phi, 9) AS phi, round(sigma2, 0) AS sigma2, round(llf, 4) AS llf,
  round(2 * 2.0 - 2 * llf, 4) AS aic, round(2.0 * ln(n) - 2 * llf, 4) AS bic FROM l""", "bars_daily"), ("FM1",))
def arima_fit_ar1(spark, sf):
    f = ar.arima_fit(_bars(spark, sf), order=(1, 1, 0))
    f = f.select("series", "n", F.col("phi")[0].alias("phi"), "sigma2", "llf", "aic", "bic")
    return round_df(f, {"phi": 9, "sigma2": 0, "llf": 4, "aic": 4, "bic": 4})


@query("arima_fit", None, ("FM1",))
def arima_fit(spark, sf):
    """ARIMA(3,1,3) Hannan-Rissanen fit per series: phi, theta, sigma2, AIC, BIC."""
    return ar.arima_fit(_bars(spark, sf), order=(3, 1, 3))


@query("arima_residuals", None, ("FM4",))
def arima_residuals(spark, sf):
    return ar.arima_residuals(_bars(spark, sf), order=(3, 1, 3))


@query("arima_forecast", None, ("FM2", "UD1"))
def arima_forecast(spark, sf):
    """Forecasts for t+1, t+2 and t+5 from the last bar of every series."""
    return ar.arima_forecast(_bars(spark, sf), order=(3, 1, 3), horizons=(1, 2, 5))


# FM2 / UD1 / SNK6: saved models, and requests with a horizon per row ------------------

_AR1 = f"""{_Z.strip()},
ar1 AS (SELECT series, sum(z * z1) / sum(z1 * z1) AS phi FROM zz WHERE z1 IS NOT NULL GROUP BY series),
last AS (SELECT series, max(dt) AS as_of, arg_max(z, dt) AS z FROM zz GROUP BY series),
lasty AS (SELECT series, arg_max(close, dt) AS y FROM bars_daily GROUP BY series),
state AS (SELECT series, as_of, z, y, phi FROM last JOIN lasty USING (series) JOIN ar1 USING (series))"""


def _powers(h: int, first: int = 1) -> str:
    """Sum of phi^i for i = first .. first + h - 1."""
    return "(" + " + ".join(f"pow(phi, {i})" for i in range(first, first + h)) + ")"


def _saved_ar1(spark, sf):
    """ARIMA(1,1,0) models of all series, saved and loaded back."""
    from ..sources.sinks import load_models, save_models
    from .landing_q import _scratch
    path = _scratch(spark, "ar1-models")
    save_models(ar.model_table(_bars(spark, sf), order=(1, 1, 0)), path, trained_date="2024-01-01")
    return load_models(spark, path)


_STEPS = "CASE coalesce(horizon, 1) " + " ".join(f"WHEN {h} THEN {_powers(h)}" for h in range(1, 8)) + " END"


@query("saved_model_forecast", with_ctes(f"""
WITH {_AR1},
req AS (SELECT series, CAST(CASE WHEN dayofweek(dt) < 6 THEN dayofweek(dt) + 1 END AS INTEGER) AS horizon, count(*) AS asked FROM bars_daily GROUP BY 1, 2)
SELECT r.series, horizon, asked, as_of, round(y + z * {_STEPS}, 4) AS forecast FROM req r JOIN state s ON s.series = r.series""", "bars_daily"), ("UD1", "SNK6", "FM2"))
def saved_model_forecast(spark, sf):
    """Forecasts from loaded models: every bar asks for as many steps as its weekday has
    (none given on Saturdays: one step), equal requests once."""
    dow = F.dayofweek("dt")
    req = _bars(spark, sf).groupBy("series", F.when(dow < 7, dow).alias("horizon")).agg(F.count(F.lit(1)).alias("asked"))
    return round_df(ar.forecast(_saved_ar1(spark, sf), req), {"forecast": 4})


@query("forecast_files", with_ctes(f"""
WITH {_AR1}
SELECT series, CAST(as_of AS VARCHAR) AS as_of, 'ARIMA' AS model_type, 'ar1_saved' AS model_name, 'from a saved model' AS note, h AS horizon_days,
  round(y + z * CASE h WHEN 1 THEN {_powers(1)} ELSE {_powers(2)} END, 4) AS price FROM state, (SELECT unnest([1, 2]) AS h)""", "bars_daily"),
       ("SNK4", "SRC6", "FM11", "PF15", "SNK6"))
def forecast_files(spark, sf):
    """Daily payloads from saved models, written as JSON files, overwritten by a second write and read back."""
    from ..operators import forecasts as fc
    from .landing_q import _scratch
    models = _saved_ar1(spark, sf)
    asked = models.select("series", F.explode(F.array(F.lit(1), F.lit(2))).alias("horizon"))
    payload = fc.daily_payload(ar.forecast(models, asked), "ar1_saved", "ARIMA", "from a saved model")
    path = _scratch(spark, "forecasts") + "/predictions/latest"
    fc.write_forecasts(payload.withColumn("note", F.lit("stale")), path)
    fc.write_forecasts(payload, path)
    return round_df(fc.forecast_long(fc.scan_forecasts(spark, path)), {"price": 4})


# FM1-FM4 with a moving average: with a first stage AR(1), ARIMA(1,1,1) is a 2 x 2 solve.
_MA1 = f"""{_Z.strip()},
a AS (SELECT series, sum(z * z1) / sum(z1 * z1) AS pa FROM zz WHERE z1 IS NOT NULL GROUP BY series),
e AS (SELECT zz.series, dt, z, z1, z - pa * z1 AS e FROM zz JOIN a ON a.series = zz.series),
ee AS (SELECT *, lag(e) OVER (PARTITION BY series ORDER BY dt) AS e1 FROM e),
s AS (SELECT series, count(*) AS n, sum(z1 * z1) AS a11, sum(z1 * e1) AS a12, sum(e1 * e1) AS a22, sum(z * z1) AS b1, sum(z * e1) AS b2, sum(z * z) AS yy
  FROM ee WHERE z1 IS NOT NULL AND e1 IS NOT NULL GROUP BY series),
f AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS phi, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS theta FROM s),
g AS (SELECT *, (yy - 2 * (phi * b1 + theta * b2) + phi * phi * a11 + 2 * phi * theta * a12 + theta * theta * a22) / n AS sigma2 FROM f)"""


@query("arima_fit_111", with_ctes(f"""
WITH {_MA1}, l AS (SELECT *, -CAST(n AS DOUBLE) / 2 * (ln(2 * pi() * sigma2) + 1) AS llf FROM g)
SELECT series, n, round(phi, 7) AS phi, round(theta, 7) AS theta, round(sigma2, 0) AS sigma2, round(llf, 4) AS llf, round(6.0 - 2 * llf, 4) AS aic,
  round(3.0 * ln(n) - 2 * llf, 4) AS bic FROM l""", "bars_daily"), ("FM1",))
def arima_fit_111(spark, sf):
    f = ar.arima_fit(_bars(spark, sf), order=(1, 1, 1), m=1)
    f = f.select("series", "n", F.col("phi")[0].alias("phi"), F.col("theta")[0].alias("theta"), "sigma2", "llf", "aic", "bic")
    return round_df(f, {"phi": 7, "theta": 7, "sigma2": 0, "llf": 4, "aic": 4, "bic": 4})


@query("arima_residuals_111", with_ctes(f"""
WITH {_MA1}
SELECT ee.series, dt, round(z - phi * z1 - theta * e1, 4) AS residual FROM ee JOIN g ON g.series = ee.series WHERE z1 IS NOT NULL AND e1 IS NOT NULL""", "bars_daily"), ("FM4",))
def arima_residuals_111(spark, sf):
    return round_df(ar.arima_residuals(_bars(spark, sf), order=(1, 1, 1), m=1), {"residual": 4})


@query("arima_forecast_111", with_ctes(f"""
WITH {_MA1},
last AS (SELECT series, max(dt) AS as_of, arg_max(z, dt) AS z, arg_max(e, dt) AS e FROM ee GROUP BY series),
lasty AS (SELECT series, arg_max(close, dt) AS y FROM bars_daily GROUP BY series)
SELECT series, as_of, CAST(h AS INTEGER) AS horizon,
  round(y + (phi * z + theta * e) * CASE h WHEN 1 THEN {_powers(1, 0)} WHEN 2 THEN {_powers(2, 0)} ELSE {_powers(5, 0)} END, 4) AS forecast
FROM g JOIN last USING (series) JOIN lasty USING (series), (SELECT unnest([1, 2, 5]) AS h)""", "bars_daily"), ("FM2",))
def arima_forecast_111(spark, sf):
    f = ar.forecast(ar.model_table(b := _bars(spark, sf), order=(1, 1, 1), m=1), b.select("series").distinct().select("series", F.explode(F.array(*map(F.lit, (1, 2, 5)))).alias("horizon")))
    return round_df(f.select("series", "as_of", "horizon", "forecast"), {"forecast": 4})


# Orders of integration 0 (with a constant) and 2 -----------------------------------

@query("arima_level", with_ctes(f"""
WITH x AS (SELECT series, dt, close, lag(close) OVER (PARTITION BY series ORDER BY dt) AS c1 FROM bars_daily),
f AS (SELECT series, regr_slope(close, c1) AS phi, regr_intercept(close, c1) AS c, max(dt) AS as_of, arg_max(close, dt) AS y FROM x GROUP BY series)
SELECT series, round(phi, 7) AS phi, round(c, 2) AS const, as_of, CAST(h AS INTEGER) AS horizon,
  round(CASE h {' '.join(f'WHEN {h} THEN pow(phi, {h}) * y + c * {_powers(h, 0)}' for h in (1, 2, 5))} END, 4) AS forecast
FROM f, (SELECT unnest([1, 2, 5]) AS h)""", "bars_daily"), ("FM1", "FM2"))
def arima_level(spark, sf):
    """ARIMA(1,0,0) with a constant: fit and forecasts."""
    m = ar.model_table(_bars(spark, sf), order=(1, 0, 0), m=1)
    f = ar.forecast(m, m.select("series", F.col("phi")[0].alias("phi"), "const", F.explode(F.array(*map(F.lit, (1, 2, 5)))).alias("horizon")))
    return round_df(f, {"phi": 7, "const": 2, "forecast": 4})


@query("arima_second_difference", with_ctes(f"""
WITH x AS (SELECT series, dt, close, close - lag(close) OVER w AS d1, close - 2 * lag(close) OVER w + lag(close, 2) OVER w AS z FROM bars_daily WINDOW w AS (PARTITION BY series ORDER BY dt)),
xx AS (SELECT *, lag(z) OVER (PARTITION BY series ORDER BY dt) AS z1 FROM x),
f AS (SELECT series, sum(z * z1) / sum(z1 * z1) AS phi FROM xx WHERE z1 IS NOT NULL GROUP BY series),
l AS (SELECT series, max(dt) AS as_of, arg_max(close, dt) AS y, arg_max(d1, dt) AS d1, arg_max(z, dt) AS z FROM xx GROUP BY series)
SELECT series, round(phi, 7) AS phi, as_of, CAST(h AS INTEGER) AS horizon, round(CASE h {' '.join(
    f"WHEN {h} THEN y + {h} * d1 + z * (" + " + ".join(f"{h - i + 1} * pow(phi, {i})" for i in range(1, h + 1)) + ")" for h in (1, 2, 5))} END, 4) AS forecast
FROM f JOIN l USING (series), (SELECT unnest([1, 2, 5]) AS h)""", "bars_daily"), ("FM1", "FM2"))
def arima_second_difference(spark, sf):
    """ARIMA(1,2,0): the recursion integrates twice."""
    m = ar.model_table(_bars(spark, sf), order=(1, 2, 0), m=1)
    f = ar.forecast(m, m.select("series", F.col("phi")[0].alias("phi"), F.explode(F.array(*map(F.lit, (1, 2, 5)))).alias("horizon")))
    return round_df(f, {"phi": 7, "forecast": 4})


@query("expanding_ar1", with_ctes(f"""
WITH {_Z.strip()},
c AS (SELECT series, dt, sum(z * z1) OVER (PARTITION BY series ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sxy,
  sum(z1 * z1) OVER (PARTITION BY series ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sxx FROM zz)
SELECT series, dt, round(CASE WHEN sxx > 0 THEN sxy / sxx END, 9) AS phi FROM c""", "bars_daily"), ("WN18",))
def expanding_ar1(spark, sf):
    """AR(1) refit at every origin from expanding moment sums."""
    e = ar.expanding_ar1(_bars(spark, sf))
    return round_df(e.select("series", "dt", "phi"), {"phi": 9})


def _metric_names(m):
    """FM8: the six run metrics {rmse,mae,mape}_next_{day,week}."""
    day, week = F.col("horizon") == 1, F.col("horizon") == 5
    cols = []
    for name in ("rmse", "mae", "mape"):
        cols.append(F.max(F.when(day, F.col(name))).alias(f"{name}_next_day"))
        cols.append(F.max(F.when(week, F.col(name))).alias(f"{name}_next_week"))
    return m.groupBy("series").agg(*cols)


@query("arima_backtest", None, ("FM3", "FM8", "JN4", "AG4"))
def arima_backtest(spark, sf):
    """Rolling-origin ARIMA(3,1,3) backtest on the last 20 % of every series,
    scored target-aligned; the six run metrics per series."""
    b = _bars(spark, sf)
    fc = ar.rolling_backtest(b, order=(3, 1, 3), horizons=(1, 5), ratio=0.8)
    test = ev.time_split(b.select("series", "dt", "close"), 0.8).where(F.col("split") == "test")
    actuals = test.select("series", "idx", F.col("close").alias("actual"))
    j = ev.align(fc, actuals, "target")
    return _metric_names(ev.forecast_metrics(j, ["series", "horizon"]))


@query("arima_backtest_origin", None, ("FM3", "JN3"))
def arima_backtest_origin(spark, sf):
    """The same backtest scored origin-aligned (every horizon against test[i])."""
    b = _bars(spark, sf)
    fc = ar.rolling_backtest(b, order=(3, 1, 3), horizons=(1, 5), ratio=0.8)
    test = ev.time_split(b.select("series", "dt", "close"), 0.8).where(F.col("split") == "test")
    j = ev.align(fc, test.select("series", "idx", F.col("close").alias("actual")), "origin")
    return _metric_names(ev.forecast_metrics(j, ["series", "horizon"]))


def _backtest_ar1_sql() -> str:
    from .evaluate_q import metrics_sql
    six = ", ".join(f"max(CASE WHEN horizon = {h} THEN {m} END) AS {m}_next_{tag}" for m in ("rmse", "mae", "mape") for h, tag in ((1, "day"), (5, "week")))
    return with_ctes(f"""
WITH {_Z.strip()},
c AS (SELECT zz.series, zz.dt, close AS y, z, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY zz.series) AS n,
  sum(z * z1) OVER w / sum(z1 * z1) OVER w AS phi FROM zz JOIN bars_daily b ON b.series = zz.series AND b.dt = zz.dt
  WINDOW w AS (PARTITION BY zz.series ORDER BY zz.dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o AS (SELECT *, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS cut FROM c),
fc AS (SELECT series, rn + 1 - cut AS idx, CAST(h AS INTEGER) AS horizon, y + z * CASE h WHEN 1 THEN {_powers(1)} ELSE {_powers(5)} END AS predicted
  FROM o, (SELECT unnest([1, 5]) AS h) WHERE rn >= cut - 1 AND rn + 1 < n),
t AS (SELECT series, rn - cut AS idx, n - cut AS n_test, y AS actual FROM o WHERE rn >= cut),
j AS (SELECT fc.series, horizon, actual, predicted FROM fc JOIN t ON t.series = fc.series AND t.idx = least(fc.idx + horizon - 1, n_test - 1))
SELECT series, {six} FROM ({metrics_sql("j", "series, horizon")}) m GROUP BY series""", "bars_daily")


@query("arima_backtest_ar1", _backtest_ar1_sql(), ("FM3", "FM8", "JN4"))
def arima_backtest_ar1(spark, sf):
    """The rolling-origin backtest with ARIMA(1,1,0), whose refits are expanding sums."""
    from .evaluate_q import _r
    b = _bars(spark, sf)
    fc = ar.rolling_backtest(b, order=(1, 1, 0), horizons=(1, 5), ratio=0.8, m=1)
    test = ev.time_split(b.select("series", "dt", "close"), 0.8).where(F.col("split") == "test")
    j = ev.align(fc, test.select("series", "idx", F.col("close").alias("actual")), "target")
    return _metric_names(_r(ev.forecast_metrics(j, ["series", "horizon"])))


# TS6 ----------------------------------------------------------------------

def _adf_lag0_sql() -> str:
    n, b = "CAST(n AS DOUBLE)", "b"
    tau = f"({b} / sqrt(((syy - sxy * sxy / sxx) / ({n} - 2)) / sxx))"
    p = sm.adf_pvalue(sm.S(tau), sm.SqlOps)
    return with_ctes(f"""
WITH m AS (SELECT series, avg(close) AS mu FROM bars_daily GROUP BY series),
x AS (SELECT b.series, close - lag(close) OVER (PARTITION BY b.series ORDER BY dt) AS dy,
  lag(close - mu) OVER (PARTITION BY b.series ORDER BY dt) AS ylag FROM bars_daily b JOIN m ON b.series = m.series),
r AS (SELECT series, regr_count(dy, ylag) AS n, regr_slope(dy, ylag) AS b, regr_sxx(dy, ylag) AS sxx,
  regr_syy(dy, ylag) AS syy, regr_sxy(dy, ylag) AS sxy FROM x GROUP BY series)
SELECT series, round({tau}, 6) AS adf_stat, round({p}, 6) AS p_value, 0 AS used_lag, CAST(n AS BIGINT) AS nobs,
  {p} < 0.05 AS stationary FROM r""", "bars_daily")


@query("adf_lag0", _adf_lag0_sql(), ("TS6",))
def adf_lag0(spark, sf):
    """Dickey-Fuller with a constant and no augmentation lags on the price level."""
    a = adf_test(_bars(spark, sf), "close", autolag=False, lag=0)
    return round_df(a, {"adf_stat": 6, "p_value": 6})


def _adf_lag1_sql() -> str:
    """Two regressors about their means: the level and one lagged difference."""
    det = "(s11 * s22 - s12 * s12)"
    b1, b2 = f"((s1y * s22 - s2y * s12) / {det})", f"((s2y * s11 - s1y * s12) / {det})"
    tau = f"({b1} / sqrt((syy - {b1} * s1y - {b2} * s2y) / (n - 3) * s22 / {det}))"
    p = sm.adf_pvalue(sm.S("tau"), sm.SqlOps)
    return with_ctes(f"""
WITH m AS (SELECT series, avg(close) AS mu FROM bars_daily GROUP BY series),
x AS (SELECT b.series, b.dt, close - lag(close) OVER (PARTITION BY b.series ORDER BY dt) AS dy,
  lag(close - mu) OVER (PARTITION BY b.series ORDER BY dt) AS yl FROM bars_daily b JOIN m ON b.series = m.series),
y AS (SELECT *, lag(dy) OVER (PARTITION BY series ORDER BY dt) AS d1 FROM x),
r AS (SELECT series, CAST(count(*) AS DOUBLE) AS n, regr_sxx(dy, yl) AS s11, regr_sxx(dy, d1) AS s22, regr_sxy(yl, d1) AS s12, regr_sxy(dy, yl) AS s1y,
  regr_sxy(dy, d1) AS s2y, regr_syy(dy, yl) AS syy FROM y WHERE d1 IS NOT NULL GROUP BY series),
t AS (SELECT series, n, {tau} AS tau FROM r)
SELECT series, round(tau, 6) AS adf_stat, round({p}, 6) AS p_value, 1 AS used_lag, CAST(n AS BIGINT) AS nobs, {p} < 0.05 AS stationary FROM t""", "bars_daily")


@query("adf_lag1", _adf_lag1_sql(), ("TS6",))
def adf_lag1(spark, sf):
    """Augmented Dickey-Fuller with one lagged difference on the price level."""
    return round_df(adf_test(_bars(spark, sf), "close", autolag=False, lag=1), {"adf_stat": 6, "p_value": 6})


@query("adf_test", None, ("TS6",))
def adf_test_q(spark, sf):
    """ADF with AIC lag choice on the price level and on simple returns."""
    b = _bars(spark, sf)
    price = adf_test(b, "close").withColumn("variable", F.lit("close"))
    rets = adf_test(st.simple_returns(b), "returns").withColumn("variable", F.lit("returns"))
    return price.unionByName(rets)


@query("arima_residual_diagnostics", None, ("FM4", "TS2", "TS3", "TS4", "TS7"))
def arima_residual_diagnostics(spark, sf):
    """The EDA verdict on ARIMA(3,1,3) residuals (Ljung-Box, D'Agostino, Jarque-Bera)."""
    r = ar.arima_residuals(_bars(spark, sf), order=(3, 1, 3))
    lb = st.ljung_box(st.acf(r, "residual", 30), 10)
    return st.residual_verdict(lb, st.normality_tests(r, "residual"))
