"""Evaluation queries (SP1-SP2, PF8, PF11, JN3-JN5, AG4, AG14-AG15, WN17)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators.layout import series_layout
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from .registry import query, round_df
from .sql import INF, pdiv

PRICE_METRICS = {"rmse": 4, "mae": 4, "mean_price": 4, "baseline_value": 4, "best_value": 4}
PCT_METRICS = {"mape": 6, "rmse_pct": 6, "mae_pct": 6, "improvement_pct": 6}
ROUND = {**PRICE_METRICS, **PCT_METRICS}
MODELS = ["naive", "ma5"]


def _r(df):
    return round_df(df, {c: d for c, d in ROUND.items() if c in df.columns})


def metrics_sql(src: str, group: str, actual="actual", predicted="predicted") -> str:
    """AG4 in SQL over ``src`` grouped by ``group`` (same rules as Spark)."""
    a, p = actual, predicted
    ok = f"({a} IS NOT NULL AND NOT isnan({a}) AND {p} IS NOT NULL AND NOT isnan({p}))"
    g = (f"SELECT {group}, count(CASE WHEN {ok} THEN {a} - {p} END) AS n_samples, "
         f"sum(CASE WHEN {ok} THEN ({a} - {p}) * ({a} - {p}) END) AS sse, "
         f"sum(CASE WHEN {ok} THEN abs({a} - {p}) END) AS sae, sum(CASE WHEN {ok} THEN {a} END) AS sa, "
         f"sum(CASE WHEN {ok} THEN abs({pdiv(f'{a} - {p}', a)}) END) AS sape FROM {src} GROUP BY {group}")
    rmse, mae, mean = "sqrt(sse / n_samples)", "(sae / n_samples)", "(sa / n_samples)"
    return (f"SELECT {group}, "
            f"round(CASE WHEN n_samples > 0 THEN {rmse} ELSE {INF} END, 4) AS rmse, "
            f"round(CASE WHEN n_samples > 0 THEN {mae} ELSE {INF} END, 4) AS mae, "
            f"round(CASE WHEN n_samples > 0 THEN sape / n_samples * 100 ELSE {INF} END, 6) AS mape, "
            f"round(CASE WHEN n_samples > 0 THEN {pdiv(rmse, mean)} * 100 ELSE {INF} END, 6) AS rmse_pct, "
            f"round(CASE WHEN n_samples > 0 THEN {pdiv(mae, mean)} * 100 ELSE {INF} END, 6) AS mae_pct, "
            f"n_samples, round(CASE WHEN n_samples > 0 THEN {mean} END, 4) AS mean_price FROM ({g}) _g")


# ---------------------------------------------------------------------------

@query("time_split", with_ctes("""
SELECT series, dt, close, CASE WHEN rn < cut THEN 'train' ELSE 'test' END AS split,
  CASE WHEN rn < cut THEN rn ELSE rn - cut END AS idx, CASE WHEN rn < cut THEN cut ELSE n - cut END AS n_split
FROM (SELECT *, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS cut FROM (
  SELECT series, dt, close, row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS rn,
         count(*) OVER (PARTITION BY series) AS n FROM bars_daily) a) b""", "bars_daily"), ("SP1",))
def time_split(spark, sf):
    return ev.time_split(fixtures.bars_daily(spark, sf).select("series", "dt", "close"), 0.8)


@query("three_way_split", with_ctes("""
SELECT series, dt, close, CASE WHEN rn < t THEN 'train' WHEN rn < t + v THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT) AS t, CAST(floor(n * CAST(0.15 AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT series, dt, close, row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS rn,
        count(*) OVER (PARTITION BY series) AS n FROM bars_daily) a) b""", "bars_daily"), ("SP2",))
def three_way_split(spark, sf):
    return ev.three_way_split(fixtures.bars_daily(spark, sf).select("series", "dt", "close"), 0.7, 0.15)


@query("forecast_metrics", with_ctes(metrics_sql("forecasts", "series, model, horizon"), "forecasts"),
       ("AG4", "PF8", "FM7"))
def forecast_metrics(spark, sf):
    return _r(ev.forecast_metrics(fixtures.forecasts(spark, sf), ["series", "model", "horizon"]))


# Naive rolling-origin backtest: at test step i the forecast for every horizon
# is the last known close; scored with both alignments (JN3, JN4).
_BACKTEST_SQL = with_ctes("""
WITH s AS (
  SELECT series, dt, close, lag(close) OVER (PARTITION BY series ORDER BY dt) AS last_close,
    row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS rn, count(*) OVER (PARTITION BY series) AS n
  FROM bars_daily),
t AS (SELECT *, rn - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS idx,
  n - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n_split FROM s
  WHERE rn >= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)),
h AS (SELECT 1 AS horizon UNION ALL SELECT 5),
a AS (SELECT 'origin' AS alignment UNION ALL SELECT 'target'),
f AS (SELECT t.series, t.idx, h.horizon, a.alignment, t.last_close AS predicted,
  CASE WHEN a.alignment = 'origin' THEN t.idx ELSE least(t.idx + h.horizon - 1, t.n_split - 1) END AS tgt
  FROM t, h, a),
j AS (SELECT f.series, f.horizon, f.alignment, f.predicted, t.close AS actual FROM f JOIN t
  ON f.series = t.series AND f.tgt = t.idx)
""" + metrics_sql("j", "series, horizon, alignment"), "bars_daily")


@query("backtest_naive", _BACKTEST_SQL, ("FM3", "JN3", "JN4", "SP1", "AG4"))
def backtest_naive(spark, sf):
    b = fixtures.bars_daily(spark, sf)
    lay = series_layout(b.select("series", "dt", "close"), lookback=1)
    b = lay.finish(lay.df.select("*", F.lag("close").over(lay.window()).alias("last_close")))
    test = ev.time_split(b, 0.8).where(F.col("split") == "test")
    actuals = test.select("series", "idx", F.col("close").alias("actual"))
    outs = []
    for h in (1, 5):
        fc = test.select("series", "idx", "n_split", F.lit(h).alias("horizon"),
                         F.col("last_close").alias("predicted"))
        for mode in ("origin", "target"):
            outs.append(ev.align(fc, actuals, mode).withColumn("alignment", F.lit(mode)))
    j = reduce(lambda x, y: x.unionByName(y), outs)
    return _r(ev.forecast_metrics(j, ["series", "horizon", "alignment"]))


@query("align_prefix", with_ctes("""
WITH p AS (SELECT series, model, predicted, row_number() OVER (PARTITION BY series, model ORDER BY dt) AS k
           FROM forecasts WHERE predicted IS NOT NULL),
a AS (SELECT series, close AS actual, row_number() OVER (PARTITION BY series ORDER BY dt) AS k FROM bars_daily),
j AS (SELECT p.series, p.model, p.predicted, a.actual FROM p JOIN a ON p.series = a.series AND p.k = a.k)
""" + metrics_sql("j", "series, model"), "forecasts"), ("JN5",))
def align_prefix(spark, sf):
    """The reference's positional tree scoring: k-th prediction vs k-th bar."""
    f = fixtures.forecasts(spark, sf).where(F.col("predicted").isNotNull())
    b = fixtures.bars_daily(spark, sf).select("series", "dt", F.col("close").alias("actual"))
    # one sequence of predictions per series and model
    tagged = lambda d: d.withColumn("of", F.concat_ws("|", "series", "model"))
    names = f.select("series", "model").distinct()
    j = ev.align_prefix(tagged(f).select("of", "dt", "predicted"), tagged(b.join(names, "series")).select("of", "dt", "actual"), ("of",))
    at = F.split("of", "\\|")
    return _r(ev.forecast_metrics(j.select(at[0].alias("series"), at[1].alias("model"), "actual", "predicted"), ["series", "model"]))


_M = metrics_sql("forecasts", "series, model, horizon")
_LONG_SQL = " UNION ALL ".join(
    f"SELECT series, model, horizon, '{m}' AS metric, {m} AS value FROM ({_M}) _m{i}"
    for i, m in enumerate(ev.METRICS))


def _metrics(spark, sf):
    return _r(ev.forecast_metrics(fixtures.forecasts(spark, sf), ["series", "model", "horizon"]))


@query("metric_long", with_ctes(_LONG_SQL, "forecasts"), ("AG14",))
def metric_long(spark, sf):
    return ev.metric_long(_metrics(spark, sf), ["series", "model", "horizon"])


@query("metric_matrix", with_ctes(
    "SELECT series, horizon, metric, " + ", ".join(
        f"round(max(CASE WHEN model = '{m}' THEN value END), 4) AS {m}" for m in MODELS)
    + f" FROM ({_LONG_SQL}) _l GROUP BY series, horizon, metric", "forecasts"), ("AG14",))
def metric_matrix(spark, sf):
    return ev.metric_matrix(_metrics(spark, sf), MODELS, ["series", "horizon"], digits=4)


@query("rank_models", with_ctes(f"""
SELECT series, horizon, model, rmse AS value, 'rmse' AS metric,
  CAST(row_number() OVER (PARTITION BY series, horizon ORDER BY rmse, list_position(['naive', 'ma5'], model)) AS INTEGER) AS rank
FROM ({_M}) _m WHERE rmse IS NOT NULL AND NOT isnan(rmse) AND abs(rmse) <> {INF}""", "forecasts"), ("WN17", "PF11"))
def rank_models(spark, sf):
    return ev.rank_models(_metrics(spark, sf), MODELS, ["series", "horizon"], "rmse")


@query("improvement_pct", with_ctes(f"""
SELECT series, horizon, best_model, baseline_value, best_value,
  round(CASE WHEN best_model = 'naive' THEN 0.0 ELSE {pdiv('baseline_value - best_value', 'baseline_value')} * 100 END, 6)
  AS improvement_pct
FROM (SELECT series, horizon, max(CASE WHEN model = 'naive' THEN rmse END) AS baseline_value, min(rmse) AS best_value,
  arg_min(model, (rmse, model)) AS best_model FROM ({_M}) _m
  WHERE rmse IS NOT NULL AND NOT isnan(rmse) AND abs(rmse) <> {INF} GROUP BY series, horizon) g""", "forecasts"),
    ("AG15",))
def improvement_pct(spark, sf):
    return _r(ev.improvement_pct(_metrics(spark, sf), ["series", "horizon"], baseline="naive"))
