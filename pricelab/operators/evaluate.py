"""Splits, forecast alignment, accuracy metrics and model comparison
(SP1, SP2, PF8, PF11, JN3-JN5, AG4, AG14, AG15, WN17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import inf, pdiv
from .layout import OWN, POS, series_layout, with_positions

METRICS = ("rmse", "mae", "mape", "rmse_pct", "mae_pct")


# ---------------------------------------------------------------------------
# SP1 / SP2: ordered splits per series
# ---------------------------------------------------------------------------

def time_split(df: DataFrame, ratio: float = 0.8, series: str = "series", order="dt",
               mode: str = "auto") -> DataFrame:
    """SP1: first ``int(n*ratio)`` rows of each series are 'train', the rest 'test'.
    Adds ``split``, ``idx`` (position inside the split) and ``n_split``."""
    p = with_positions(df, series, order, mode)
    cut = F.floor(F.col("_n") * F.lit(float(ratio))).cast("long")
    train = F.col(POS) < cut
    out = p.select("*", F.when(train, "train").otherwise("test").alias("split"),
                   F.when(train, F.col(POS)).otherwise(F.col(POS) - cut).alias("idx"),
                   F.when(train, cut).otherwise(F.col("_n") - cut).alias("n_split"))
    return out.drop(POS, "_n")


def three_way_split(df: DataFrame, train: float = 0.7, val: float = 0.15, series: str = "series",
                    order="dt", mode: str = "auto") -> DataFrame:
    """SP2: train = first int(n*0.7), val = next int(n*0.15), test = rest."""
    p = with_positions(df, series, order, mode)
    n = F.col("_n")
    t_end = F.floor(n * F.lit(float(train))).cast("long")
    v_end = t_end + F.floor(n * F.lit(float(val))).cast("long")
    pos = F.col(POS)
    split = F.when(pos < t_end, "train").when(pos < v_end, "val").otherwise("test")
    return p.select("*", split.alias("split")).drop(POS, "_n")


# ---------------------------------------------------------------------------
# PF8 / PF11
# ---------------------------------------------------------------------------

def _valid(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def valid_pairs(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """PF8: keep pairs where both values are present (not NULL / NaN)."""
    return df.where(_valid(F.col(actual)) & _valid(F.col(predicted)))


def finite_only(df: DataFrame, c: str) -> DataFrame:
    """PF11: drop NaN / +-inf metric values before ranking."""
    x = F.col(c)
    return df.where(_valid(x) & (F.abs(x) != inf()))


# ---------------------------------------------------------------------------
# AG4: accuracy metrics
# ---------------------------------------------------------------------------

def forecast_metrics(df: DataFrame, group: list[str], actual: str = "actual",
                     predicted: str = "predicted") -> DataFrame:
    """AG4 per group: rmse, mae, mape (%), rmse_pct, mae_pct (of mean actual),
    n_samples, mean_price. Only valid pairs count; a group without any gets
    +inf for the five metrics and n_samples = 0. actual = 0 makes MAPE inf.
    One hash aggregate with map-side partial sums."""
    a, p = F.col(actual), F.col(predicted)
    ok = _valid(a) & _valid(p)
    err = F.when(ok, a - p)
    n = F.count(err)
    sse = F.sum(err * err)
    sae = F.sum(F.abs(err))
    sa = F.sum(F.when(ok, a))
    sape = F.sum(F.when(ok, F.abs(pdiv(a - p, a))))
    g = df.groupBy(*group).agg(n.alias("n_samples"), sse.alias("_sse"), sae.alias("_sae"),
                               sa.alias("_sa"), sape.alias("_sape"))
    nn = F.col("n_samples")
    has = nn > 0
    rmse = F.sqrt(F.col("_sse") / nn)
    mae = F.col("_sae") / nn
    mean = F.col("_sa") / nn
    cols = [F.when(has, rmse).otherwise(inf()).alias("rmse"),
            F.when(has, mae).otherwise(inf()).alias("mae"),
            F.when(has, F.col("_sape") / nn * 100).otherwise(inf()).alias("mape"),
            F.when(has, pdiv(rmse, mean) * 100).otherwise(inf()).alias("rmse_pct"),
            F.when(has, pdiv(mae, mean) * 100).otherwise(inf()).alias("mae_pct"),
            nn.alias("n_samples"), F.when(has, mean).alias("mean_price")]
    return g.select(*group, *cols)


# ---------------------------------------------------------------------------
# JN3 / JN4 / JN5: forecast alignment
# ---------------------------------------------------------------------------

def align(forecasts: DataFrame, actuals: DataFrame, mode: str = "target", keys=("series",),
          origin: str = "idx", horizon: str = "horizon", n_test: str = "n_split") -> DataFrame:
    """Join each forecast to the actual it is scored against.

    ``forecasts``: keys, origin index (test step), horizon, predicted, n_test.
    ``actuals``: keys, idx, actual (the test split).
    * ``origin`` (JN3): actual at the origin step itself, every horizon.
    * ``target`` (JN4, default): actual at ``least(origin + h - 1, n_test - 1)``.
    Equi-join on (keys, target index): both sides shuffle by the same keys."""
    o, h = F.col(origin), F.col(horizon)
    if mode == "origin":
        tgt = o
    elif mode == "target":
        tgt = F.least(o + h - 1, F.col(n_test) - 1)
    else:
        raise ValueError(mode)
    f = forecasts.withColumn("_target", tgt.cast("long"))
    a = actuals.select(*keys, F.col("idx").cast("long").alias("_target"), "actual")
    return f.join(a, [*keys, "_target"]).drop("_target")


def align_prefix(preds: DataFrame, actuals: DataFrame, keys=("series",), pred_order="dt",
                 actual_order="dt") -> DataFrame:
    """JN5: positional pairing of the k-th prediction with the k-th actual row
    (the reference's tree scoring; off by the dropped warm-up rows). Kept for
    parity only."""
    k = list(keys)
    series = k[0] if len(k) == 1 else None
    if series is None:
        wp = Window.partitionBy(*k).orderBy(pred_order)
        wa = Window.partitionBy(*k).orderBy(actual_order)
        p = preds.withColumn("_k", F.row_number().over(wp))
        a = actuals.select(*k, F.row_number().over(wa).alias("_k"), "actual")
    else:  # skew-safe positions per series
        p = with_positions(preds, series, pred_order).withColumnRenamed(POS, "_k").drop("_n")
        a = with_positions(actuals.select(series, actual_order, "actual"), series, actual_order) \
            .select(series, F.col(POS).alias("_k"), "actual")
    return p.join(a, [*k, "_k"]).drop("_k")


# ---------------------------------------------------------------------------
# AG14 / AG15 / WN17: comparison tables
# ---------------------------------------------------------------------------

def metric_long(metrics: DataFrame, keys: list[str], metric_names=METRICS) -> DataFrame:
    """AG14 (long): one row per (keys, metric) with ``value``."""
    return metrics.unpivot(keys, list(metric_names), "metric", "value")


def metric_matrix(metrics: DataFrame, models: list[str], keys: list[str], model_col: str = "model",
                  metric_names=METRICS, digits: int = 2) -> DataFrame:
    """AG14 (pivot): metric rows x model columns, rounded. The model list is
    given, so the pivot needs no extra job to discover values."""
    lng = metric_long(metrics, [*keys, model_col], metric_names)
    return (lng.groupBy(*keys, "metric").pivot(model_col, models).agg(F.first("value"))
            .select(*keys, "metric", *[F.round(F.col(m), digits).alias(m) for m in models]))


def rank_models(metrics: DataFrame, models: list[str], keys: list[str], metric: str,
                model_col: str = "model", ascending: bool = True) -> DataFrame:
    """WN17: ranks 1..n by ``metric``; invalid (NULL/NaN/inf) excluded; ties keep
    the given model order (stable sort)."""
    m = finite_only(metrics, metric)
    pos = F.array_position(F.array(*[F.lit(x) for x in models]), F.col(model_col))
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.partitionBy(*keys).orderBy(order, pos)
    return m.select(*keys, model_col, F.col(metric).alias("value"), F.lit(metric).alias("metric"),
                    F.row_number().over(w).cast("int").alias("rank"))


def improvement_pct(metrics: DataFrame, keys: list[str], baseline: str, metric: str = "rmse",
                    model_col: str = "model") -> DataFrame:
    """AG15: (baseline - best) / baseline * 100 when the best model is not the
    baseline; 0 when it is. One conditional aggregate per key."""
    m = finite_only(metrics, metric)
    base = F.max(F.when(F.col(model_col) == baseline, F.col(metric)))
    best_val = F.min(F.col(metric))
    best_model = F.min_by(F.col(model_col), F.struct(F.col(metric), F.col(model_col)))
    g = m.groupBy(*keys).agg(base.alias("baseline_value"), best_val.alias("best_value"),
                             best_model.alias("best_model"))
    imp = F.when(F.col("best_model") == baseline, F.lit(0.0)).otherwise(
        pdiv(F.col("baseline_value") - F.col("best_value"), F.col("baseline_value")) * 100)
    return g.select(*keys, "best_model", "baseline_value", "best_value", imp.alias("improvement_pct"))


# ---------------------------------------------------------------------------
# Comparison of models on the same targets
# ---------------------------------------------------------------------------

def with_targets(preds: DataFrame, bars: DataFrame, horizons, series: str = "series", dt: str = "dt",
                 price: str = "close", mode: str = "auto") -> DataFrame:
    """``preds`` (series, origin_dt, horizon, ...) with ``target_dt`` and ``actual``: the bar
    ``horizon`` rows after the origin. Origins without such a bar drop out."""
    lay = series_layout(bars.select(series, dt, price), series, dt, lookahead=max(horizons), mode=mode)
    w = lay.window()
    # windows first: a generator may not hold them
    cols = [c for h in horizons for c in (F.lead(dt, h).over(w).alias(f"_t{h}"), F.lead(price, h).over(w).alias(f"_a{h}"))]
    keep = [OWN] if lay.halo else []
    led = lay.finish(lay.df.select(series, F.col(dt).alias("origin_dt"), *keep, *cols))
    ahead = F.explode(F.array(*[F.struct(F.lit(int(h)).alias("horizon"), F.col(f"_t{h}").alias("target_dt"), F.col(f"_a{h}").alias("actual")) for h in horizons]))
    truth = led.select(series, "origin_dt", ahead.alias("a")).select(series, "origin_dt", "a.*").where(F.col("target_dt").isNotNull())
    return preds.join(truth, [series, "origin_dt", "horizon"])


def common_targets(preds: DataFrame, models: list[str], keys: list[str], model_col: str = "model",
                   predicted: str = "predicted") -> DataFrame:
    """Rows of the targets (``keys``) that every one of ``models`` predicted, so that scores are
    over the same bars. Groups are one row a model; a model's rows for one target are one vote."""
    ok = F.when(_valid(F.col(predicted)) & F.col(model_col).isin(*models), F.col(model_col))
    w = Window.partitionBy(*keys)
    voted = preds.withColumn("_models", F.size(F.collect_set(ok).over(w)))
    return voted.where((F.col("_models") == len(models)) & F.col(model_col).isin(*models)).drop("_models")


def comparison(metrics: DataFrame, models: list[str], keys: list[str], ranked=("rmse", "mape"), digits: int = 4) -> DataFrame:
    """One row per (keys, metric): all five metrics by model, ranks of the models for the
    ``ranked`` ones, the best model and how many bars were scored (the same for all)."""
    matrix = metric_matrix(metrics, models, keys, digits=digits)
    ranks = None
    for m in ranked:
        r = rank_models(metrics, models, keys, m)
        ranks = r if ranks is None else ranks.unionByName(r)
    by = ranks.groupBy(*keys, "metric").agg(*[F.max(F.when(F.col("model") == m, F.col("rank"))).alias(f"rank_{m}") for m in models],
                                            F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("best_model"))
    n = metrics.groupBy(*keys).agg(F.max("n_samples").alias("n_samples"))
    return matrix.join(by, [*keys, "metric"], "left").join(n, keys)
