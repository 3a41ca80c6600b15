"""ADF from Toeplitz sums against plain regressions on lag matrices, in both layouts."""

import numpy as np
import pytest

from pricelab.operators.stationarity import adf_test, max_lag, nested_ssr

from conftest import bars_frame


def regression(x, lag, drop):
    """t-value of the level and AIC parts of the regression with ``lag`` lags, ``drop`` first differences left out."""
    yc, dy = x - x.mean(), np.diff(x)
    t = np.arange(drop, len(dy))
    X = np.stack([np.ones(len(t)), yc[t], *[dy[t - i] for i in range(1, lag + 1)]], 1)
    b, *_ = np.linalg.lstsq(X, dy[t], rcond=None)
    r = ((dy[t] - X @ b) ** 2).sum()
    n, k = X.shape
    aic = n * (np.log(2 * np.pi) + np.log(r / n) + 1) + 2 * k
    return b[1] / np.sqrt(r / (n - k) * np.linalg.inv(X.T @ X)[1, 1]), aic, n


def expected(x, search=True, lag=0):
    m = max_lag(len(x)) if search else min(lag, max_lag(len(x)))
    best = min(range(m + 1), key=lambda k: regression(x, k, m)[1]) if search else m
    tau, _, n = regression(x, best, best)
    return best, n, tau


def shapes():
    rng = np.random.default_rng(5)
    ar = np.zeros(400)
    for i in range(2, 400):
        ar[i] = 0.6 * ar[i - 1] - 0.3 * ar[i - 2] + rng.normal()
    seasonal = np.sin(np.arange(300) * 2 * np.pi / 7) * 5 + rng.normal(size=300)
    return {"walk": 1e5 + rng.normal(size=500).cumsum() * 100, "ar2": ar, "seasonal": seasonal, "short": rng.normal(size=12), "walk2": rng.normal(size=300).cumsum()}


@pytest.mark.parametrize("mode", ["plain", "halo"])
def test_lag_and_statistic(spark, mode, monkeypatch):
    from pricelab.operators import layout
    data, df = shapes(), None
    for name, x in data.items():
        f = bars_frame(spark, x, name)
        df = f if df is None else df.unionByName(f)
    spark.conf.set(layout.CHUNK_ROWS_KEY, "120")
    try:
        got = {r.series: r for r in adf_test(df, "close", mode=mode).collect()}
        one = {r.series: r for r in adf_test(df, "close", autolag=False, lag=1, mode=mode).collect()}
    finally:
        spark.conf.unset(layout.CHUNK_ROWS_KEY)
    for name, x in data.items():
        for r, want in ((got[name], expected(x)), (one[name], expected(x, False, 1))):
            assert (r.used_lag, r.nobs) == want[:2] and r.adf_stat == pytest.approx(want[2], rel=1e-6), name


def test_degenerate_series(spark):
    df = bars_frame(spark, [3.0] * 40, "flat").unionByName(bars_frame(spark, [1.0, 2.0], "two")).unionByName(bars_frame(spark, np.arange(50.0), "line"))
    got = {r.series: r for r in adf_test(df, "close").collect()}
    assert set(got) == {"flat", "two", "line"} and all(r.adf_stat is None for r in got.values())


def test_plan_is_linear_in_lags(spark):
    """Twice the lags, about twice the plan."""
    from pricelab.operators import stationarity as st
    from pricelab.operators.layout import POS, with_positions
    x = with_positions(bars_frame(spark, np.arange(30.0)).select("series", "dt", "close"), mode="plain").withColumn("_at", st.F.col(POS))
    size = lambda L: len(st._sums(x, "close", "series", "dt", L, st.F.lit(3), "plain")._jdf.queryExecution().optimizedPlan().toString())
    assert (size(40) - size(20)) < 2.6 * (size(20) - size(10))


def test_nested_sums_of_squares():
    rng = np.random.default_rng(0)
    X, y = rng.normal(size=(60, 6)), rng.normal(size=60)
    X[:, 5] = X[:, 4] * 2                       # collinear from here on
    out = nested_ssr((X.T @ X)[None], (X.T @ y)[None], np.array([y @ y]))[0]
    for k in range(2, 6):
        b = np.linalg.lstsq(X[:, :k], y, rcond=None)[0]
        assert out[k - 2] == pytest.approx(((y - X[:, :k] @ b) ** 2).sum())
    assert np.isnan(out[4])
