"""Feature-model and forecast-payload queries (AG12-AG13, WN15, FM5-FM7,
FM11-FM12, SL6, UD2, SRC6, SNK4, PF15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import arima as ar
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import forecasts as fc
from ..operators import ml
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from ..operators.layout import resolve_mode, series_layout
from ..session import cut_lineage
from .evaluate_q import _r, metrics_sql
from .features_q import features_sql
from .registry import query, round_df

OPT = list(fe.OPTIMIZED_FEATURES)
_RAW_FEATURES_SQL, _FEATURE_COLS = features_sql("bars_daily", rounded=False)
_SPLIT = f"""f AS (SELECT * FROM ({_RAW_FEATURES_SQL}) _f),
s AS (SELECT *, CASE WHEN rn < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS rn,
        count(*) OVER (PARTITION BY series) AS n FROM f) a)"""


def _optimized(spark, sf):
    """The optimized features, targets and price: nothing else is computed but what
    decides which rows are complete."""
    bars = fixtures.bars_daily(spark, sf)
    mode = resolve_mode(bars)
    f = fe.complete_rows(fe.create_features(bars, drop_incomplete=False, mode=mode))
    return f.select("series", "dt", "close", *OPT, *fe.TARGETS), mode


def _split_features(spark, sf):
    """Optimized features with their 80/20 split, materialised once in the shared
    checkpoint folder: several fits and scorings read it."""
    f, mode = _optimized(spark, sf)
    return cut_lineage(ev.time_split(f, 0.8, mode=mode))


def _scale_sql() -> str:
    stats = ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in OPT)
    scaled = ", ".join(
        f'round((s."{c}" - st."m_{c}") / CASE WHEN st."s_{c}" = 0 THEN 1.0 ELSE st."s_{c}" END, 8) AS "{c}"'
        for c in OPT)
    return (f"WITH {_SPLIT},\nst AS (SELECT series, {stats} FROM s WHERE split = 'train' GROUP BY series)\n"
            f"SELECT s.series, s.dt, s.split, {scaled} FROM s JOIN st ON s.series = st.series")


@query("standard_scale", _scale_sql(), ("AG12", "SP1"))
def standard_scale(spark, sf):
    """Optimized features scaled with train-split statistics per series."""
    f = _split_features(spark, sf).select("series", "dt", "split", *OPT)
    out = ml.standard_scale(f, OPT, fit_on=F.col("split") == "train")
    return round_df(out, {c: 8 for c in OPT})


_CORR_FEATURES = [c for c in _FEATURE_COLS if c not in ("series", "dt", "open", "high", "low", "close", "volume",
                                                        "y_day", "y_week")]


def _corr_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT series, '{c}' AS feature, corr(CAST(\"{c}\" AS DOUBLE), y_day) AS c FROM s WHERE split = 'train' "
        f"GROUP BY series" for c in _CORR_FEATURES)
    return (f"WITH {_SPLIT},\nl AS (SELECT series, feature, CASE WHEN isnan(c) THEN NULL ELSE c END AS c FROM ({rows}) u),\n"
            "r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY round(abs(c), 9) DESC NULLS LAST, feature) AS rk FROM l)\n"
            "SELECT series, feature, round(c, 9) AS corr, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 12")


@query("top_correlated_features", _corr_sql(), ("AG13", "PF12"))
def top_correlated_features(spark, sf):
    """Top 12 of the 96 features by |corr| with next-day close, train split only."""
    bars = fixtures.bars_daily(spark, sf)
    mode = resolve_mode(bars)
    # materialised: correlations of a hundred columns are too large a plan on top of the windows
    f = cut_lineage(ev.time_split(fe.create_features(bars, mode=mode), 0.8, mode=mode)).where(F.col("split") == "train")
    out = ml.top_k_by_correlation(f, fe.feature_columns(f.drop("split", "idx", "n_split")), "y_day", 12)
    return round_df(out.select("series", "feature", "corr", "rank"), {"corr": 9})


def _seq_sql() -> str:
    w = "OVER (PARTITION BY series ORDER BY dt)"
    return (f"WITH f AS (SELECT * FROM ({_RAW_FEATURES_SQL}) _f),\n"
            f"q AS (SELECT series, dt, row_number() {w} AS rn, lag(lag_1, 30) {w} AS x_first, lag(lag_1, 1) {w} AS x_last,\n"
            f"  lag(bb_middle, 1) {w} AS x_last_feature, y_day AS y,\n"
            f"  sum({' + '.join(OPT)}) OVER (PARTITION BY series ORDER BY dt ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS x_total FROM f)\n"
            "SELECT series, dt, 30 AS n_steps, round(x_first, 4) AS x_first, round(x_last, 4) AS x_last,\n"
            "  round(x_last_feature, 4) AS x_last_feature, round(x_total, 2) AS x_total, round(y, 4) AS y FROM q WHERE rn > 30")


@query("sequences", _seq_sql(), ("WN15",))
def sequences(spark, sf):
    """30-step windows of the optimized features with next-day target; summarised
    by size, corner values and the total of all values for the check."""
    f, _ = _optimized(spark, sf)
    s = ml.build_sequences(f, OPT, "y_day", 30)
    out = s.select("series", "dt", F.size("X").alias("n_steps"), F.col("X")[0][0].alias("x_first"),
                   F.col("X")[29][0].alias("x_last"), F.col("X")[29][len(OPT) - 1].alias("x_last_feature"),
                   F.aggregate(F.flatten("X"), F.lit(0.0), lambda a, x: a + x).alias("x_total"), "y")
    return round_df(out, {"x_first": 4, "x_last": 4, "x_last_feature": 4, "x_total": 2, "y": 4})


@query("gbt_train_test_metrics", None, ("FM5", "FM7", "AG12"))
def gbt_train_test_metrics(spark, sf):
    """Boosted trees (reference settings) on scaled optimized features, day and
    week models, train and test metrics."""
    f = _split_features(spark, sf)
    f = ml.standard_scale(f, OPT, fit_on=F.col("split") == "train", suffix="_z")
    return ml.train_test_metrics(f, [c + "_z" for c in OPT], "gbt")


@query("rf_train_test_metrics", None, ("FM6", "FM7"))
def rf_train_test_metrics(spark, sf):
    f = _split_features(spark, sf)
    f = ml.standard_scale(f, OPT, fit_on=F.col("split") == "train", suffix="_z")
    return ml.train_test_metrics(f, [c + "_z" for c in OPT], "rf")


@query("tree_latest_forecast", None, ("SL6", "UD2", "FM5"))
def tree_latest_forecast(spark, sf):
    """Day and week boosted-tree forecasts from each series' newest feature row
    (features computed without targets, so the row is today's bar)."""
    bars = fixtures.bars_daily(spark, sf)
    train = cut_lineage(fe.create_features(bars))
    live = fe.create_features(bars, targets=False)
    latest = ml.latest_rows(live)
    outs = []
    for h in (1, 5):
        model = ml.fit_trees(train, OPT, h, "gbt")
        outs.append(ml.predict_trees(model, latest, OPT, h))
    return outs[0].unionByName(outs[1])


@query("ensemble", with_ctes("""
SELECT series, dt, horizon, round(sum(w * predicted) / sum(w), 4) AS ensemble, count(*) AS n_models FROM (
  SELECT *, CASE WHEN model = 'naive' THEN 0.7 ELSE 0.3 END AS w FROM forecasts
  WHERE model IN ('naive', 'ma5') AND predicted IS NOT NULL) f GROUP BY series, dt, horizon""", "forecasts"),
    ("FM12",))
def ensemble(spark, sf):
    """70/30 blend of two forecasters; where one is missing the other is used."""
    e = ml.ensemble(fixtures.forecasts(spark, sf), {"naive": 0.7, "ma5": 0.3})
    return round_df(e, {"ensemble": 4})


@query("forecast_long", with_ctes(f"""
SELECT series, CAST(max(dt) AS VARCHAR) AS as_of, '{fc.DEFAULT_MODEL_TYPE}' AS model_type,
  '{fc.DEFAULT_MODEL_NAME}' AS model_name, '{fc.DEFAULT_NOTE}' AS note, h.horizon_days,
  arg_max(close, dt) AS price
FROM bars_daily, (SELECT 1 AS horizon_days UNION ALL SELECT 2) h GROUP BY series, h.horizon_days""", "bars_daily"),
    ("SNK4", "SRC6", "PF15", "FM11"))
def forecast_long(spark, sf):
    """Naive daily payload (tomorrow = day after = last close) -> JSON -> parsed
    back -> long form with defaults."""
    b = fixtures.bars_daily(spark, sf)
    last = b.groupBy("series").agg(F.max("dt").alias("as_of"), F.max_by("close", "dt").alias("c"))
    long = last.select("series", "as_of", F.explode(F.array(F.lit(1), F.lit(2))).alias("horizon"),
                       F.col("c").alias("forecast"))
    payload = fc.daily_payload(long, model_name=None, model_type=None, note=None)
    parsed = fc.parse_payload(fc.to_json_lines(payload))
    return fc.forecast_long(parsed)


@query("daily_forecasts", None, ("FM11", "FM2"))
def daily_forecasts(spark, sf):
    """ARIMA(3,1,3) t+1 / t+2 payload per series."""
    f = ar.arima_forecast(fixtures.bars_daily(spark, sf), order=(3, 1, 3), horizons=(1, 2))
    return fc.daily_payload(f)


COMPARE_MODELS = ["ARIMA", "GBT", "RF"]


@query("model_comparison", None, ("FM3", "FM5", "FM6", "AG4", "AG14", "AG15", "WN17"))
def model_comparison(spark, sf):
    """ARIMA(3,1,3) rolling backtest, boosted trees and a random forest on the last 20 % of every
    series, day and week: all five metrics over the targets that all three
    predicted, ranks by RMSE and MAPE, the improvement of the best over ARIMA."""
    from functools import reduce

    bars = fixtures.bars_daily(spark, sf)
    origin = F.col("dt").alias("origin_dt")
    arima = ar.rolling_backtest(bars, order=(3, 1, 3), horizons=(1, 5), ratio=0.8) \
        .select("series", F.lit("ARIMA").alias("model"), "horizon", "origin_dt", "predicted")
    # Trees on scaled optimized features, predicting from the rows of their test split.
    f = _split_features(spark, sf)
    f = ml.standard_scale(f, OPT, fit_on=F.col("split") == "train", suffix="_z")
    cols = [c + "_z" for c in OPT]
    train, test_f = f.where(F.col("split") == "train"), f.where(F.col("split") == "test")
    trees = []
    for kind, name in (("gbt", "GBT"), ("rf", "RF")):
        for h in (1, 5):
            model = ml.fit_trees(train, cols, h, kind)
            trees.append(ml.predict_trees(model, test_f, cols, h).select("series", F.lit(name).alias("model"), "horizon", origin, "predicted"))
    preds = cut_lineage(reduce(lambda a, b: a.unionByName(b), [arima, *trees]))
    keys = ["series", "horizon"]
    scored = ev.common_targets(ev.with_targets(preds, bars, (1, 5)), COMPARE_MODELS, [*keys, "target_dt"])
    metrics = cut_lineage(ev.forecast_metrics(scored, [*keys, "model"]))
    imp = ev.improvement_pct(metrics, keys, baseline="ARIMA")
    return ev.comparison(metrics, COMPARE_MODELS, keys, digits=2).join(imp.select(*keys, "improvement_pct"), keys)


_SIMPLE = ["naive", "ma5", "ma20"]


def _comparison_sql() -> str:
    values = " UNION ALL ".join(f"SELECT series, horizon, '{m}' AS metric, " + ", ".join(f"round(max(CASE WHEN model = '{x}' THEN {m} END), 4) AS {x}" for x in _SIMPLE)
                                + " FROM m GROUP BY series, horizon" for m in ev.METRICS)
    ranks = " UNION ALL ".join(
        f"SELECT series, horizon, '{m}' AS metric, model, row_number() OVER (PARTITION BY series, horizon ORDER BY {m}, list_position({_SIMPLE!r}, model)) AS rk FROM m"
        for m in ("rmse", "mape"))
    return with_ctes(f"""
WITH o AS (SELECT series, dt, close AS naive, lead(close, 1) OVER w AS a1, lead(close, 5) OVER w AS a5,
  CASE WHEN count(*) OVER f5 = 5 THEN avg(close) OVER f5 END AS ma5, CASE WHEN count(*) OVER f20 = 20 THEN avg(close) OVER f20 END AS ma20 FROM bars_daily
  WINDOW w AS (PARTITION BY series ORDER BY dt), f5 AS (PARTITION BY series ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
  f20 AS (PARTITION BY series ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
c AS (SELECT * FROM o WHERE ma20 IS NOT NULL),
p AS ({' UNION ALL '.join(f"SELECT series, {h} AS horizon, '{x}' AS model, {x} AS predicted, a{h} AS actual FROM c WHERE a{h} IS NOT NULL" for h in (1, 5) for x in _SIMPLE)}),
m AS ({metrics_sql("p", "series, horizon, model")}),
v AS ({values}),
r AS ({ranks}),
rr AS (SELECT series, horizon, metric, {', '.join(f"CAST(max(CASE WHEN model = '{x}' THEN rk END) AS INTEGER) AS rank_{x}" for x in _SIMPLE)},
  max(CASE WHEN rk = 1 THEN model END) AS best_model FROM r GROUP BY series, horizon, metric),
n AS (SELECT series, horizon, max(n_samples) AS n_samples FROM m GROUP BY series, horizon)
SELECT v.*, {', '.join(f'rank_{x}' for x in _SIMPLE)}, best_model, n_samples FROM v LEFT JOIN rr USING (series, horizon, metric) JOIN n USING (series, horizon)""", "bars_daily")


@query("comparison_common_targets", _comparison_sql(), ("AG14", "WN17", "FM7"))
def comparison_common_targets(spark, sf):
    """Last close and two means, whose histories begin at different bars, scored on the
    targets that all of them predicted."""
    bars = fixtures.bars_daily(spark, sf)
    lay = series_layout(bars.select("series", "dt", "close"), lookback=20)
    frame = lambda k: lay.window().rowsBetween(1 - k, 0)
    mean = lambda k: F.when(F.count("close").over(frame(k)) == k, F.avg("close").over(frame(k)))
    p = lay.finish(lay.df.select("*", F.col("close").alias("naive"), mean(5).alias("ma5"), mean(20).alias("ma20")))
    long = p.select("series", F.col("dt").alias("origin_dt"), "naive", "ma5", "ma20").unpivot(["series", "origin_dt"], _SIMPLE, "model", "predicted")
    preds = long.select("*", F.explode(F.array(F.lit(1), F.lit(5))).alias("horizon"))
    keys = ["series", "horizon"]
    scored = ev.common_targets(ev.with_targets(preds, bars, (1, 5)), _SIMPLE, [*keys, "target_dt"])
    return ev.comparison(_r(ev.forecast_metrics(scored, [*keys, "model"])), _SIMPLE, keys)
