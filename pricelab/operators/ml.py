"""Feature models over many series (AG12, AG13, WN15, FM5-FM7, FM12, SL6, UD2).

Tree models are Spark ML estimators trained on the pooled series. Levels do
not extrapolate across series, so the default target is relative
(``y / close - 1``), converted back to a price for scoring; ``target='level'``
keeps the reference's raw target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import forecast_metrics
from .layout import OWN, series_layout

# Reference boosted-tree settings: 100 trees, depth 6, learning rate 0.1,
# row subsample 0.8, column subsample 0.8, seed 42.
GBT_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)
RF_PARAMS = dict(numTrees=100, maxDepth=10, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
HORIZON_TARGET = {1: "y_day", 5: "y_week"}


def standard_scale(df: DataFrame, cols: list[str], fit_on: Column | None = None, series: str = "series",
                   suffix: str = "") -> DataFrame:
    """AG12: (x - mean) / std with the *population* std of the fitting rows
    (train split by default), per series; a zero std divides by 1."""
    fit = df.where(fit_on) if fit_on is not None else df
    st = fit.groupBy(series).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                 *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.join(st, series)
    scaled = [((F.col(c) - F.col(f"_m_{c}")) /
               F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))).alias(c + suffix)
              for c in cols]
    keep = [c for c in df.columns if c not in cols or suffix]
    return j.select(*keep, *scaled)


def top_k_by_correlation(df: DataFrame, cols: list[str], target: str, k: int = 12,
                         series: str = "series") -> DataFrame:
    """AG13: features ranked by |corr(feature, target)| per series, rounded to nine
    digits so that features equal by definition tie whatever the summation order (ties by name).
    One aggregate pass of all correlations, then a rank over <= len(cols) rows."""
    g = df.groupBy(series).agg(*[F.corr(F.col(c).cast("double"), target).alias(c) for c in cols])
    g = g.select(series, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in cols])  # constant -> NULL
    lng = g.select(series, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr"))
                                               for c in cols])).alias("r")).select(series, "r.*")
    w = Window.partitionBy(series).orderBy(F.round(F.abs("corr"), 9).desc_nulls_last(), F.col("feature"))
    return lng.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def build_sequences(df: DataFrame, cols: list[str], target: str, seq_len: int = 30, series: str = "series",
                    dt: str = "dt") -> DataFrame:
    """WN15: X = feature rows t-seq_len .. t-1, y = target at t; n - seq_len rows
    per series. Bounded frame (seq_len rows), so no group grows with the data."""
    lay = series_layout(df, series, dt, lookback=seq_len)
    w = lay.window().rowsBetween(-seq_len, -1)
    x = F.collect_list(F.array(*[F.col(c).cast("double") for c in cols])).over(w)
    keep = [OWN] if lay.halo else []
    out = lay.finish(lay.df.select(series, dt, x.alias("X"), F.col(target).alias("y"), *keep))
    return out.where(F.size("X") == seq_len)


def _assemble(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(df)


def fit_trees(train: DataFrame, cols: list[str], horizon: int, kind: str = "gbt", target: str = "relative",
              price: str = "close", params: dict | None = None):
    """FM5 / FM6: one model per horizon (day -> y_day, week -> y_week)."""
    y = HORIZON_TARGET[horizon]
    label = (F.col(y) / F.col(price) - 1) if target == "relative" else F.col(y)
    data = _assemble(train.where(F.col(y).isNotNull()), cols).withColumn("label", label)
    if kind == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol="label", **(params or GBT_PARAMS))
    elif kind == "rf":
        est = RandomForestRegressor(featuresCol="features", labelCol="label", **(params or RF_PARAMS))
    else:
        raise ValueError(kind)
    return est.fit(data)


def predict_trees(model, df: DataFrame, cols: list[str], horizon: int, target: str = "relative",
                  price: str = "close", keep=("series", "dt")) -> DataFrame:
    """Predicted price for ``horizon`` (UD2: horizon 1 -> day model, 5 -> week)."""
    if horizon not in HORIZON_TARGET:
        raise ValueError("horizon must be 1 (day) or 5 (week)")
    p = model.transform(_assemble(df, cols))
    pred = F.col("prediction")
    price_pred = (F.col(price) * (1 + pred)) if target == "relative" else pred
    y = HORIZON_TARGET[horizon]
    extra = [F.col(y).alias("actual")] if y in df.columns else []
    return p.select(*keep, F.lit(horizon).alias("horizon"), price_pred.alias("predicted"), *extra)


def predict_requests(models: dict, latest: DataFrame, requests: DataFrame, cols: list[str], target: str = "relative",
                     series: str = "series", dt: str = "dt") -> DataFrame:
    """UD2: ``requests`` (series, horizon, ...) with ``as_of``, ``forecast`` and ``reason`` from each series' latest
    feature row and the model of the horizon. A series without a feature row and a horizon
    that no model has come back with a NULL forecast and the reason."""
    scored = [predict_trees(m, latest, cols, h, target, keep=(series, dt)).select(series, F.col(dt).alias("as_of"), "horizon", F.col("predicted").alias("forecast"))
              for h, m in sorted(models.items())]
    offered = F.col("horizon").isin(*models)
    out = requests.join(reduce(lambda a, b: a.unionByName(b), scored), [series, "horizon"], "left")
    known = ", ".join(str(h) for h in sorted(models))
    return out.withColumn("reason", F.when(F.col("horizon").isNull() | ~offered, f"horizon must be one of {known}")
                          .when(F.col("as_of").isNull(), "no feature row"))


def train_test_metrics(features: DataFrame, cols: list[str], kind: str = "gbt", horizons=(1, 5),
                       target: str = "relative", split_col: str = "split") -> DataFrame:
    """FM7: AG4 metrics on the train and test predictions for each horizon."""
    outs = []
    train = features.where(F.col(split_col) == "train")
    for h in horizons:
        model = fit_trees(train, cols, h, kind, target)
        pred = predict_trees(model, features, cols, h, target, keep=("series", "dt", split_col))
        outs.append(pred.withColumn("model", F.lit(kind)))
    allp = reduce(lambda a, b: a.unionByName(b), outs)
    return forecast_metrics(allp, ["model", "horizon", split_col])


def latest_rows(features: DataFrame, series: str = "series", dt: str = "dt") -> DataFrame:
    """SL6: the newest feature row per series (grouped max_by, map-side)."""
    cols = [c for c in features.columns if c != series]
    g = features.groupBy(series).agg(F.max_by(F.struct(*cols), F.col(dt)).alias("_r"))
    return g.select(series, "_r.*")


def ensemble(forecasts: DataFrame, weights: dict[str, float], keys=("series", "dt", "horizon"),
             model_col: str = "model", value: str = "predicted") -> DataFrame:
    """FM12: weighted mean of the forecasts present for a target (weights
    renormalised over the models that have a value; a missing model falls back
    to the other). One grouped aggregate."""
    wexpr = F.lit(None).cast("double")
    for m, wt in weights.items():
        wexpr = F.when(F.col(model_col) == m, F.lit(float(wt))).otherwise(wexpr)
    f = forecasts.where(F.col(model_col).isin(*weights) & F.col(value).isNotNull()).withColumn("_w", wexpr)
    return f.groupBy(*keys).agg((F.sum(F.col("_w") * F.col(value)) / F.sum("_w")).alias("ensemble"),
                                F.count(F.lit(1)).alias("n_models"))
