"""Lifecycle B: bars -> trailing window -> rolling ARIMA backtest -> run record
-> registration -> promotion -> daily forecast payload.

Every step is a DataFrame over all series at once; the driver only sees the
final small tables it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import arima as ar
from ..operators import evaluate as ev
from ..operators import forecasts as fc
from ..operators import registry as rg
from ..operators.selection import trailing_window


def backtest_metrics(bars: DataFrame, order=(3, 1, 3), years: float = 3, ratio: float = 0.8,
                     alignment: str = "target") -> DataFrame:
    b = trailing_window(bars, years)
    preds = ar.rolling_backtest(b, order, horizons=(1, 5), ratio=ratio)
    test = ev.time_split(b.select("series", "dt", "close"), ratio).where(F.col("split") == "test")
    j = ev.align(preds, test.select("series", "idx", F.col("close").alias("actual")), alignment)
    m = ev.forecast_metrics(j, ["series", "horizon"])
    cols = []
    for name in ("rmse", "mae", "mape"):
        for h, tag in ((1, "day"), (5, "week")):
            cols.append(F.max(F.when(F.col("horizon") == h, F.col(name))).alias(f"{name}_next_{tag}"))
    return m.groupBy("series").agg(*cols)


def run_record(metrics: DataFrame, bars: DataFrame, order=(3, 1, 3), years: float = 3) -> DataFrame:
    p, d, q = order
    return rg.run_records(metrics, trailing_window(bars, years), F.lit("arima"), F.lit("arima"), {"p": str(p), "d": str(d), "q": str(q), "rolling_years": str(years)},
                          ["series"], tags={"lifecycle": "training"}, artifacts=["model/MLmodel"])


def daily_payload(bars: DataFrame, order=(3, 1, 3)) -> DataFrame:
    return fc.daily_payload(ar.arima_forecast(bars, order, horizons=(1, 2)))
