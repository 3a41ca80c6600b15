"""Chunked (halo) layouts give the same rows as whole-series windows."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest


@pytest.fixture(scope="module")
def long_series(spark):
    rng = np.random.default_rng(2)
    rows = []
    d0 = dt.date(2000, 1, 1)
    for s in ("A", "B"):
        y = 100 + np.cumsum(rng.normal(size=1500))
        rows += [(s, d0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series string, dt date, close double")


def _same(a: pd.DataFrame, b: pd.DataFrame, keys):
    a = a.sort_values(keys).reset_index(drop=True)
    b = b.sort_values(keys).reset_index(drop=True)
    assert a.shape == b.shape
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].to_numpy(), b[c].to_numpy(), rtol=1e-9, atol=1e-9, err_msg=c)
        else:
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_positions_and_split(spark, long_series):
    from pricelab.operators.evaluate import time_split
    a = time_split(long_series, 0.8, mode="plain").toPandas()
    b = time_split(long_series, 0.8, mode="halo:400").toPandas()
    _same(a, b, ["series", "dt"])


def test_expanding_and_rolling_backtest(spark, long_series):
    from pricelab.operators import arima as ar
    _same(ar.expanding_ar1(long_series, mode="plain").toPandas(),
          ar.expanding_ar1(long_series, mode="halo:400").toPandas(), ["series", "dt"])
    a = ar.rolling_backtest(long_series, order=(2, 1, 1), horizons=(1, 5), mode="plain").toPandas()
    b = ar.rolling_backtest(long_series, order=(2, 1, 1), horizons=(1, 5), mode="halo:400").toPandas()
    _same(a, b, ["series", "idx", "horizon"])


def test_acf_and_quantiles(spark, long_series):
    from pricelab.operators import stats as st
    from pricelab.operators.layout import with_positions
    a = st.acf(long_series, "close", 10).toPandas()
    b = st.acf(long_series, "close", 10).toPandas()
    _same(a, b, ["series", "lag"])
    pa = with_positions(long_series, order=["close"], mode="plain").toPandas()
    pb = with_positions(long_series, order=["close"], mode="halo:300").toPandas()
    _same(pa, pb, ["series", "_pos"])
