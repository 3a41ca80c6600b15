"""The EMA scan: compositions over buckets, in a plan without Python, equal the recurrence."""

import numpy as np
import pandas as pd
import pytest

from pricelab.operators import features as fe
from pricelab.operators.ema import add_ema, span_groups
from pricelab.operators.layout import series_layout

from conftest import bars_frame


def closes(n, seed=0):
    return np.round(1000 + np.random.default_rng(seed).normal(size=n).cumsum(), 2)


@pytest.mark.parametrize("mode", ["plain", "halo"])
def test_many_buckets_equal_pandas(spark, mode):
    x = closes(5000)          # five buckets of 979 rows
    bars = bars_frame(spark, x, start="2001-01-01")
    lay = series_layout(bars, lookback=fe.ema_lookback(), mode=mode, chunk_rows=2000)
    got = lay.finish(add_ema(lay)).orderBy("dt").toPandas()
    s = pd.Series(x)
    ema = lambda v, k: v.ewm(span=k, adjust=False).mean()
    for k in (7, 12, 26, 50):
        assert np.abs(got[f"ema_{k}"] - ema(s, k)).max() < 1e-9
        if mode == "plain":
            assert (got[f"ema_{k}"][:16] == ema(s, k)[:16]).all()      # bit by bit
    line = ema(s, 12) - ema(s, 26)
    assert np.abs(got["macd"] - line).max() < 1e-9 and np.abs(got["macd_signal"] - ema(line, 9)).max() < 1e-9


def test_uncommon_spans(spark):
    """Spans too far apart for common buckets, span 1, a double pole in MACD, a constant series."""
    assert span_groups((7, 12, 26, 50, 9)) == [[50, 26, 12, 9, 7]] and len(span_groups((2, 400))) == 2
    x = closes(700, 1)
    for values in (x, np.full(300, 5.25)):
        lay = series_layout(bars_frame(spark, values), mode="plain")
        got = add_ema(lay, spans=(1, 2, 400), macd=(5, 20, 5)).orderBy("dt").toPandas()
        s = pd.Series(values)
        line = s.ewm(span=5, adjust=False).mean() - s.ewm(span=20, adjust=False).mean()
        for k in (1, 2, 400):
            assert np.allclose(got[f"ema_{k}"], s.ewm(span=k, adjust=False).mean(), rtol=1e-13, atol=0)
        assert np.abs(got["macd_signal"] - line.ewm(span=5, adjust=False).mean()).max() < 1e-10


def test_plan_is_jvm_only_with_one_exchange(spark):
    f = fe.create_features(bars_frame(spark, closes(200)), mode="plain")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_complete_rows_are_those_of_drop_incomplete(spark):
    """Also with flat stretches, zero prices and missing volumes, where quotients are 0/0."""
    x = closes(260, 2)
    x[100:130] = x[100]
    x[180] = 0.0
    bars = bars_frame(spark, x).selectExpr("series", "dt", "CASE WHEN close = 0 THEN 0.0D ELSE open END AS open", "CASE WHEN close = 0 THEN 0.0D ELSE high END AS high",
                                           "CASE WHEN close = 0 THEN 0.0D ELSE low END AS low", "close", "CASE WHEN volume % 97 = 0 THEN NULL ELSE volume END AS volume")
    all_ = fe.create_features(bars, drop_incomplete=False, mode="plain")
    want = {r.dt for r in all_.na.drop("any").select("dt").collect()}
    got = fe.complete_rows(all_)
    assert {r.dt for r in got.select("dt").collect()} == want and 0 < len(want) < 205
    plan = fe.optimized_features(got)._jdf.queryExecution().optimizedPlan().toString()
    assert "_std20_close" not in plan and "_max50_close" not in plan and "_avg50_close" in plan
