import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pricelab.operators import evaluate as ev
from pricelab.operators import registry as rg


@pytest.mark.parametrize("n,train", [(1, 0), (5, 4), (7, 5), (10, 8)])
def test_time_split_cut_points(spark, n, train):
    df = spark.createDataFrame([("A", i) for i in range(n)], "series string, dt int")
    s = ev.time_split(df, 0.8, order="dt", mode="plain")
    assert s.where(F.col("split") == "train").count() == train


@pytest.mark.parametrize("n", [1, 5, 7, 10])
def test_three_way_split_cut_points(spark, n):
    df = spark.createDataFrame([("A", i) for i in range(n)], "series string, dt int")
    s = ev.three_way_split(df, 0.7, 0.15, order="dt", mode="plain").toPandas()
    t, v = int(n * 0.7), int(n * 0.15)
    assert (s["split"] == "train").sum() == t
    assert (s["split"] == "val").sum() == v
    assert (s["split"] == "test").sum() == n - t - v


def test_metrics_empty_and_zero_actual(spark):
    rows = [("A", 1.0, None), ("A", float("nan"), 2.0), ("B", 0.0, 1.0), ("B", 2.0, 1.0)]
    m = ev.forecast_metrics(spark.createDataFrame(rows, "series string, actual double, predicted double"),
                            ["series"]).orderBy("series").collect()
    a, b = m
    assert a["n_samples"] == 0 and all(math.isinf(a[k]) for k in ("rmse", "mae", "mape", "rmse_pct", "mae_pct"))
    assert b["n_samples"] == 2 and math.isinf(b["mape"]) and b["rmse"] == pytest.approx(1.0)


def test_alignment_modes(spark):
    fc = spark.createDataFrame([("A", i, 3, 5, float(i)) for i in range(3)],
                               "series string, idx long, n_split long, horizon int, predicted double")
    act = spark.createDataFrame([("A", i, 10.0 * i) for i in range(3)], "series string, idx long, actual double")
    t = {r["idx"]: r["actual"] for r in ev.align(fc, act, "target").collect()}
    o = {r["idx"]: r["actual"] for r in ev.align(fc, act, "origin").collect()}
    assert t == {0: 20.0, 1: 20.0, 2: 20.0}   # least(i + 4, n - 1)
    assert o == {0: 0.0, 1: 10.0, 2: 20.0}


def _runs(spark, rows):
    data = [(rid, "exp", "arima", dt.datetime(2024, 1, d), {"rmse_next_day": v} if v is not None else {},
             {}, ["model/MLmodel"]) for rid, d, v in rows]
    return spark.createDataFrame(data, "run_id string, experiment string, model_type string, start_time timestamp, "
                                       "metrics map<string,double>, params map<string,string>, artifacts array<string>")


@pytest.mark.parametrize("new,alert", [(110.0, False), (110.01, True)])
def test_degradation_alert_only_above_threshold(spark, new, alert):
    d = rg.degradation(_runs(spark, [("r1", 1, 100.0), ("r2", 2, new)])).collect()[0]
    assert d["alert"] is alert


def test_degradation_needs_two_runs(spark):
    d = rg.degradation(_runs(spark, [("r1", 1, 100.0)])).collect()[0]
    assert d["change_pct"] is None and d["alert"] is False


def test_latest_version_is_numeric(spark):
    v = spark.createDataFrame([("m", 2, "a"), ("m", 9, "b"), ("m", 10, "c")], "model_name string, version int, run_id string")
    r = rg.latest_version(v).collect()[0]
    assert r["version"] == 10 and r["run_id"] == "c"


def test_promote_moves_alias(spark):
    v = spark.createDataFrame([("m", 1, "a", ["Production"]), ("m", 2, "b", [])],
                              "model_name string, version int, run_id string, aliases array<string>")
    chosen = rg.unpromoted_versions(v)
    out = {r["version"]: r["aliases"] for r in rg.promote(v, chosen).collect()}
    assert out == {1: [], 2: ["Production"]}


def test_has_model_artifact(spark):
    df = spark.createDataFrame([(["model/MLmodel"],), (["arima/MLmodel"],), (["metrics.json"],)], "artifacts array<string>")
    assert [r[0] for r in df.select(rg.has_model_artifact()).collect()] == [True, True, False]
