import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import bars_frame
from pricelab.operators import features as fe


def _pandas_features(df: pd.DataFrame) -> pd.DataFrame:
    """Independent pandas formulation of the feature table (differential oracle)."""
    out = df.copy()
    c = out["close"]
    r = np.log(c).diff()
    out["return"] = r
    out["return_abs"] = r.abs()
    out["price_change"] = c.diff()
    out["price_change_pct"] = c / c.shift(1) - 1
    for k in fe.LAGS:
        out[f"lag_{k}"] = c.shift(k)
    for k in fe.ROLL_WINDOWS:
        out[f"roll_mean_{k}"] = c.rolling(k).mean()
        out[f"roll_std_{k}"] = c.rolling(k).std()
        out[f"roll_min_{k}"] = c.rolling(k).min()
        out[f"roll_max_{k}"] = c.rolling(k).max()
    for k in fe.ROLL_RETURN_WINDOWS:
        out[f"roll_return_std_{k}"] = r.rolling(k).std()
    for s in fe.EMA_SPANS:
        out[f"ema_{s}"] = c.ewm(span=s, adjust=False).mean()
    d = c.diff()
    for k in fe.RSI_WINDOWS:
        g = d.where(d > 0, 0).rolling(k).mean()
        lo = (-d.where(d < 0, 0)).rolling(k).mean()
        out[f"rsi_{k}"] = 100 - 100 / (1 + g / lo)
    line = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    out["macd"] = line
    out["macd_signal"] = line.ewm(span=9, adjust=False).mean()
    out["y_day"] = c.shift(-1)
    out["y_week"] = c.shift(-5)
    return out


def test_feature_table_matches_pandas_on_random_walks(spark):
    rng = np.random.default_rng(7)
    frames = []
    for name in ("A", "B"):
        closes = 1000 + np.cumsum(rng.normal(0, 5, 320))
        frames.append(bars_frame(spark, closes, series=name))
    bars = frames[0].unionByName(frames[1])
    got = fe.create_features(bars, drop_incomplete=False).toPandas().sort_values(["series", "dt"])
    for name, g in got.groupby("series"):
        ref = _pandas_features(g[["close"]].reset_index(drop=True))
        g = g.reset_index(drop=True)
        for col in [c for c in ref.columns if c != "close"]:
            a, b = g[col].astype(float).to_numpy(), ref[col].astype(float).to_numpy()
            assert np.array_equal(np.isnan(a), np.isnan(b)), col
            m = ~np.isnan(a)
            np.testing.assert_allclose(a[m], b[m], rtol=1e-7, atol=1e-7, err_msg=col)  # pandas rolling std is online (drifts ~1e-9)


def test_flat_prices_give_null_ratios(spark):
    bars = bars_frame(spark, [100.0] * 60, hl_spread=0.0)
    f = fe.create_features(bars, drop_incomplete=False).orderBy("dt").toPandas()
    assert f["rsi_14"].isna().all()
    assert f["bb_position"].isna().all()
    assert f["price_position_20"].isna().all()


def test_rising_prices_rsi_100_from_row_window_minus_one(spark):
    bars = bars_frame(spark, [100.0 + i for i in range(30)])
    f = fe.create_features(bars, drop_incomplete=False).orderBy("dt").toPandas()
    assert f["rsi_14"].first_valid_index() == 13
    assert (f["rsi_14"].dropna() == 100.0).all()


def test_drop_incomplete_leaves_n_minus_54(spark):
    bars = bars_frame(spark, [100.0 + (i % 7) for i in range(55)])
    assert fe.create_features(bars).count() == 1


def test_infinite_ratio_kept_by_drop_incomplete(spark):
    bars = bars_frame(spark, [100.0 + (i % 5) for i in range(60)])
    bars = bars.withColumn("low", F.when(F.col("dt") == F.lit("2024-02-20").cast("date"), 0.0).otherwise(F.col("low")))
    f = fe.create_features(bars).where(F.col("dt") == F.lit("2024-02-20").cast("date")).toPandas()
    assert len(f) == 1 and math.isinf(f["hl_ratio"][0])


def test_first_true_range_is_high_minus_low(spark):
    bars = bars_frame(spark, [100.0, 120.0, 90.0], hl_spread=2.0)
    f = fe.create_features(bars, drop_incomplete=False).orderBy("dt").toPandas()
    assert f["true_range"][0] == pytest.approx(4.0)
    assert f["true_range"][1] == pytest.approx(max(4.0, abs(122 - 100), abs(118 - 100)))


def test_calendar_flags(spark):
    rows = [("A", d) for d in ("2024-02-29", "2024-03-01", "2024-03-02", "2024-03-31")]
    df = spark.createDataFrame(rows, "series string, dt string").withColumn("dt", F.col("dt").cast("date"))
    from pricelab.functions.calendar import calendar_columns
    c = df.select("dt", *calendar_columns("dt")).orderBy("dt").toPandas()
    assert list(c["is_month_end"]) == [1, 0, 0, 1]
    assert list(c["is_month_start"]) == [0, 1, 0, 0]
    assert list(c["day_of_week"]) == [3, 4, 5, 6]
    assert list(c["is_weekend"]) == [0, 0, 1, 1]


def test_halo_layout_equals_plain(spark):
    from pricelab.sources import fixtures
    t = fixtures.ticks(spark, "/root/testdata/sf0.01")
    a = fe.create_features(t, order=["dt", "seq"], mode="plain").orderBy("series", "dt", "seq").toPandas()
    b = fe.create_features(t, order=["dt", "seq"], mode="halo", chunk_rows=1200).orderBy("series", "dt", "seq").toPandas()
    assert a.shape == b.shape
    num = [c for c in a.columns if a[c].dtype.kind == "f"]
    np.testing.assert_allclose(a[num].to_numpy(), b[num].to_numpy(), rtol=1e-12, atol=1e-9)


def test_plan_has_one_exchange_for_feature_windows(spark):
    bars = bars_frame(spark, [100.0 + i % 9 for i in range(80)])
    f = fe.create_features(bars, mode="plain")
    plan = f._jdf.queryExecution().executedPlan().toString()
    # the only exchange is the one hash partitioning the layout keys
    assert plan.count("Exchange hashpartitioning") == 1
