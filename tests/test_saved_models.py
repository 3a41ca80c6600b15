"""Model tables, forecasts by request, run log and tree models: round trips and reference recursions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.operators import arima as ar, ml, registry as rg
from pricelab.session import has_files
from pricelab.sources.sinks import load_models, load_tree_models, save_models, save_tree_models

from conftest import bars_frame


def series(n=220, seed=0):
    return 500 + np.random.default_rng(seed).normal(size=n).cumsum()


def steps(m, h):
    """The forecast recursion in plain Python."""
    z, e, lv = list(m.diffs), list(m.innovations), list(m.levels)
    for _ in range(h):
        x = m.const + sum(a * b for a, b in zip(m.phi, z)) + sum(a * b for a, b in zip(m.theta, e))
        z, e = ([x] + z)[:len(z)], ([0.0] + e)[:len(e)]
        for k in reversed(range(len(lv))):
            lv[k] += x
            x = lv[k]
    return x


@pytest.mark.parametrize("order", [(1, 0, 0), (2, 0, 1), (3, 1, 3), (0, 1, 1), (1, 2, 0), (2, 2, 2), (1, 3, 0)])
def test_forecasts_of_saved_models(spark, scratch, order):
    bars = bars_frame(spark, series(), "A").unionByName(bars_frame(spark, series(seed=1), "B"))
    save_models(ar.model_table(bars, order), scratch + "/m", trained_date="2024-06-01")
    models = load_models(spark, scratch + "/m")
    rows = {m.series: m for m in models.collect()}
    assert {(m.p, m.d, m.q, m.trained_date) for m in rows.values()} == {(*order, "2024-06-01")}
    assert all(len(m.levels) == order[1] and len(m.diffs) == order[0] and len(m.innovations) == order[2] for m in rows.values())
    requests = spark.createDataFrame([("A", 1, "x"), ("A", 7, "y"), ("B", 3, "z"), ("B", None, "none"), ("C", 2, "unknown"), ("A", 0, "zero"), ("A", -4, "past")],
                                     "series string, horizon int, tag string")
    got = {r.tag: r for r in ar.forecast(models, requests).collect()}
    for tag, name, h in (("x", "A", 1), ("y", "A", 7), ("z", "B", 3), ("none", "B", 1)):
        assert got[tag].forecast == pytest.approx(steps(rows[name], h), rel=1e-12) and got[tag].as_of == rows[name].as_of
    assert got["unknown"].forecast is None and got["unknown"].as_of is None
    assert got["zero"].forecast is None and got["past"].forecast is None


def test_short_series_have_no_forecast(spark):
    models = ar.model_table(bars_frame(spark, [1.0, 2.0, 4.0]), (3, 1, 3))
    asked = spark.createDataFrame([("A", 1)], "series string, horizon int")
    assert [r.forecast for r in ar.forecast(models, asked).collect()] == [None]


def test_forecast_has_no_python(spark):
    m = ar.model_table(bars_frame(spark, series()), (1, 1, 0))
    from pricelab.session import cut_lineage
    m = cut_lineage(m)
    plan = ar.forecast(m, m.select("series", F.lit(2).alias("horizon")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_only_model_tables_load(spark, scratch):
    ar.arima_fit(bars_frame(spark, series()), (1, 1, 0)).write.parquet(scratch + "/fit")
    with pytest.raises(ValueError, match="levels"):
        load_models(spark, scratch + "/fit")


@pytest.mark.parametrize("order", [(1, 0, 0), (1, 2, 0)])
def test_backtest_refits_at_every_origin(spark, order):
    x = series(90, 4)
    got = {(r.idx, r.horizon): r.predicted for r in ar.rolling_backtest(bars_frame(spark, x), order, horizons=(1, 3), m=1).collect()}
    cut = int(90 * 0.8)
    for i in (0, 5, 17):
        past = x[:cut + i]
        z = np.diff(past, order[1]) if order[1] else past
        X = np.stack([np.ones(len(z) - 1), z[:-1]], 1) if not order[1] else z[:-1, None]
        b = np.linalg.lstsq(X, z[1:], rcond=None)[0]
        c, phi = (b[0], b[1]) if not order[1] else (0.0, b[0])
        levels, last = [past[-1], np.diff(past)[-1]][:order[1]], z[-1]
        for h in range(1, 4):
            last = c + phi * last
            v = last
            for k in reversed(range(len(levels))):
                levels[k] += v
                v = levels[k]
            if h in (1, 3):
                assert got[i, h] == pytest.approx(v, rel=1e-8)


def test_run_log_takes_each_run_once(spark, scratch):
    data = spark.createDataFrame([("A", "2024-01-01"), ("A", "2024-01-09"), ("B", "2024-02-01")], "series string, dt string")
    metrics = spark.createDataFrame([("A", 1.5, 2.0), ("B", None, 3.0)], "series string, rmse_next_day double, mae_next_day double")
    make = lambda p: rg.run_records(metrics, data, F.lit("exp"), F.lit("arima"), {"p": p}, ["series"], tags={"t": "x"}, artifacts=["model/MLmodel"])
    path = scratch + "/log"
    assert [rg.append_runs(make("1"), path), rg.append_runs(make("1"), path), rg.append_runs(make("2").unionByName(make("1")), path)] == [2, 0, 2]
    log = {(r.params["data_end_date"], r.params["p"]): r for r in spark.read.parquet(path).collect()}
    assert set(log) == {("2024-01-09", "1"), ("2024-02-01", "1"), ("2024-01-09", "2"), ("2024-02-01", "2")}
    a = log["2024-01-09", "1"]
    assert a.params["data_samples"] == "2" and a.metrics == {"rmse_next_day": 1.5, "mae_next_day": 2.0} and a.tags == {"t": "x"}
    assert log["2024-02-01", "1"].metrics == {"mae_next_day": 3.0}
    assert len({r.run_id for r in log.values()}) == 4


def test_has_files(spark, scratch):
    import os
    assert not has_files(spark, scratch + "/none")
    os.makedirs(scratch + "/empty/sub")
    open(scratch + "/empty/_SUCCESS", "w").close()
    assert not has_files(spark, scratch + "/empty")
    spark.range(1).write.parquet(scratch + "/some")
    assert has_files(spark, scratch + "/some")


def test_tree_models_by_horizon(spark, scratch):
    rng = np.random.default_rng(0)
    rows = [("AB"[i % 2], i, float(100 + i), float(rng.normal()), float(101 + i), float(105 + i)) for i in range(80)]
    f = spark.createDataFrame(rows, "series string, dt int, close double, x double, y_day double, y_week double")
    models = {h: ml.fit_trees(f, ["x"], h, "rf", params={"numTrees": 3, "maxDepth": 2, "seed": 1}) for h in (1, 5)}
    save_tree_models(spark, models, scratch + "/trees", ["x"])
    loaded, cols, target = load_tree_models(spark, scratch + "/trees")
    assert sorted(loaded) == [1, 5] and cols == ["x"] and target == "relative"
    latest = ml.latest_rows(f)
    asked = spark.createDataFrame([("A", 1), ("A", 5), ("B", 2), ("C", 1), ("B", None)], "series string, horizon int")
    got = {(r.series, r.horizon): r for r in ml.predict_requests(loaded, latest, asked, cols, target).collect()}
    for h in (1, 5):
        want = ml.predict_trees(models[h], latest.where("series = 'A'"), cols, h).first()
        assert got["A", h].forecast == want.predicted and got["A", h].as_of == 78 and got["A", h].reason is None
    assert got["B", 2].reason == got["B", None].reason == "horizon must be one of 1, 5" and got["B", 2].forecast is None
    assert got["C", 1].reason == "no feature row"
