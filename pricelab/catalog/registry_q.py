"""Run / version registry queries (SRC5, PF9-PF11, JN1-JN2, AG5-AG7, SL3-SL5,
WN16, SNK5, FM9-FM10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry as rg
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from .registry import query, round_df
from .sql import INF, pdiv

_OK = "model_path IS NOT NULL AND rmse_day IS NOT NULL AND NOT isnan(rmse_day) AND rmse_day <> " + INF
_BEST_TYPE = f"""SELECT model_type, run_id, experiment, value FROM (
  SELECT model_type, run_id, experiment, rmse_day AS value,
    row_number() OVER (PARTITION BY model_type ORDER BY rmse_day, start_time, run_id) AS rn
  FROM runs WHERE {_OK}) x WHERE rn = 1"""
_UNPROMOTED = """SELECT model_name, coalesce(max(CASE WHEN NOT list_contains(aliases, 'Production') THEN version END),
  max(version)) AS version FROM versions GROUP BY model_name"""


def _runs(spark, sf):
    return fixtures.runs(spark, sf)


@query("runs_with_model", with_ctes(
    f"SELECT run_id, experiment, model_path IS NOT NULL AS has_model, coalesce(rmse_day, {INF}) AS rmse_or_inf "
    "FROM runs", "runs"), ("PF9", "PF10"))
def runs_with_model(spark, sf):
    return _runs(spark, sf).select("run_id", "experiment", rg.has_model_artifact().alias("has_model"),
                                   rg.metric_or_inf("rmse_next_day").alias("rmse_or_inf"))


@query("scan_runs", with_ctes("""
SELECT run_id, experiment, rmse_day AS rmse, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY rmse_day ASC NULLS LAST, run_id) AS rk
  FROM runs WHERE experiment IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) x WHERE rk <= 20""", "runs"), ("SRC5", "SL3"))
def scan_runs(spark, sf):
    r = rg.scan_runs(_runs(spark, sf), ["1-URGENT", "2-HIGH", "3-MEDIUM"], "rmse_next_day", 20)
    return r.select("run_id", "experiment", rg.metric("rmse_next_day").alias("rmse"), F.col("rank").cast("int"))


@query("latest_runs", with_ctes("""
SELECT run_id, experiment, start_time, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rk FROM runs) x
WHERE rk <= 10""", "runs"), ("SL4",))
def latest_runs(spark, sf):
    return rg.latest_runs(_runs(spark, sf), 10).select("run_id", "experiment", "start_time",
                                                       F.col("rank").cast("int"))


@query("run_summary", with_ctes("""
SELECT experiment, count(*) AS total_runs, min(rmse_day) AS best, max(rmse_day) AS worst,
  round(avg(rmse_day), 6) AS mean, max(CASE WHEN rk = 1 THEN rmse_day END) AS latest FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rk FROM runs) x
GROUP BY experiment""", "runs"), ("AG5",))
def run_summary(spark, sf):
    return round_df(rg.run_summary(_runs(spark, sf)), {"mean": 6})


@query("best_run_per_type", with_ctes(_BEST_TYPE, "runs"), ("AG6", "PF9", "PF11"))
def best_run_per_type(spark, sf):
    return rg.best_run_per_type(_runs(spark, sf))


@query("best_model_overall", with_ctes(_BEST_TYPE + " ORDER BY value, model_type LIMIT 1", "runs"), ("AG7",))
def best_model_overall(spark, sf):
    return rg.best_model_overall(rg.best_run_per_type(_runs(spark, sf)))


@query("latest_version", with_ctes(
    "SELECT model_name, max(version) AS version, arg_max(run_id, version) AS run_id FROM versions GROUP BY model_name",
    "versions"), ("SL5",))
def latest_version(spark, sf):
    return rg.latest_version(fixtures.versions(spark, sf))


@query("version_of_best_run", with_ctes(
    f"SELECT b.run_id, b.model_type, b.experiment, b.value, v.model_name, v.version, v.aliases "
    f"FROM ({_BEST_TYPE}) b JOIN versions v ON b.run_id = v.run_id", "versions"), ("JN1",))
def version_of_best_run(spark, sf):
    return rg.version_of_best_run(rg.best_run_per_type(_runs(spark, sf)), fixtures.versions(spark, sf))


@query("unpromoted_versions", with_ctes(_UNPROMOTED, "versions"), ("JN2",))
def unpromoted_versions(spark, sf):
    return rg.unpromoted_versions(fixtures.versions(spark, sf))


@query("promote", with_ctes(f"""
SELECT v.model_name, v.version, v.run_id,
  CASE WHEN c.version IS NULL THEN v.aliases
       WHEN v.version = c.version THEN list_append(list_filter(v.aliases, lambda x: x <> 'Production'), 'Production')
       ELSE list_filter(v.aliases, lambda x: x <> 'Production') END AS aliases
FROM versions v LEFT JOIN ({_UNPROMOTED}) c ON v.model_name = c.model_name""", "versions"), ("FM10", "JN2"))
def promote(spark, sf):
    v = fixtures.versions(spark, sf)
    return rg.promote(v, rg.unpromoted_versions(v))


@query("degradation", with_ctes(f"""
WITH r AS (SELECT experiment, run_id, rmse_day AS m,
  row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rk FROM runs),
g AS (SELECT experiment, max(CASE WHEN rk = 1 THEN run_id END) AS latest_run, max(CASE WHEN rk = 1 THEN m END) AS latest,
  max(CASE WHEN rk = 2 THEN m END) AS previous FROM r WHERE rk <= 2 GROUP BY experiment)
SELECT experiment, latest_run, latest, previous, round({pdiv('latest - previous', 'previous')} * 100, 6) AS change_pct,
  coalesce({pdiv('latest - previous', 'previous')} * 100 > 10.0, false) AS alert FROM g""", "runs"), ("WN16",))
def degradation(spark, sf):
    return round_df(rg.degradation(_runs(spark, sf)), {"change_pct": 6})


@query("register_best", with_ctes(f"""
WITH best AS (SELECT experiment, run_id FROM (SELECT experiment, run_id,
  row_number() OVER (PARTITION BY experiment ORDER BY rmse_day, start_time, run_id) AS rn FROM runs WHERE {_OK}) x
  WHERE rn = 1),
cur AS (SELECT model_name, max(version) AS v FROM versions GROUP BY model_name)
SELECT experiment AS model_name, CAST(coalesce(v, 0) + 1 AS INTEGER) AS version, run_id, []::VARCHAR[] AS aliases
FROM best LEFT JOIN cur ON best.experiment = cur.model_name""", "versions"), ("FM9",))
def register_best(spark, sf):
    return rg.register_best(_runs(spark, sf), fixtures.versions(spark, sf))


_RUN_ID = ("substr(sha256(concat_ws('|', series, model, series, model, CAST(horizon AS VARCHAR), data_end, CAST(data_samples AS VARCHAR), data_start, "
           "CAST(horizon AS VARCHAR), model)), 1, 32)")
_LOG = f"""SELECT {_RUN_ID} AS run_id, m.series AS experiment, m.model AS model_type, CAST(data_end AS TIMESTAMP) AS start_time, rmse, mae, mape,
  data_samples, data_start, data_end FROM ({{metrics}}) m JOIN (SELECT series, model, horizon, count(*) AS data_samples,
  CAST(min(dt) AS VARCHAR) AS data_start, CAST(max(dt) AS VARCHAR) AS data_end FROM forecasts GROUP BY series, model, horizon) d
  USING (series, model, horizon)"""


def _log_sql() -> str:
    from .evaluate_q import metrics_sql
    return _LOG.format(metrics=metrics_sql("forecasts", "series, model, horizon"))


def _run_log(spark, sf):
    """Every series, model and horizon scored, logged twice: the second time adds nothing."""
    from ..operators import evaluate as ev
    from .evaluate_q import _r
    from .landing_q import _scratch
    f = fixtures.forecasts(spark, sf)
    keys = ["series", "model", "horizon"]
    m = _r(ev.forecast_metrics(f, keys)).select(*keys, F.col("rmse").alias("rmse_next_day"), F.col("mae").alias("mae_next_day"), F.col("mape").alias("mape_next_day"))
    last = f.groupBy(*keys).agg(F.max("dt").alias("_last"))
    records = rg.run_records(m.join(last, keys).drop("_last"), f, F.col("series"), F.col("model"), {"model": F.col("model"), "horizon": F.col("horizon")}, keys,
                             tags={"kind": "baseline"}, artifacts=["model/MLmodel", "metrics.json"])
    # the run counts as started when its data ended, so that a rerun is the same run
    records = records.withColumn("start_time", F.col("params")["data_end_date"].cast("timestamp"))
    path = _scratch(spark, "run-log")
    if rg.append_runs(records, path) != m.count() or rg.append_runs(records, path):
        raise RuntimeError("the run log did not take every run once")
    return spark.read.parquet(path)


@query("log_runs", with_ctes(_log_sql(), "forecasts"), ("SNK5",))
def log_runs(spark, sf):
    """The log as it was appended: metrics, data range and sample count per run."""
    p, metric = F.col("params"), rg.metric
    return _run_log(spark, sf).select("run_id", "experiment", "model_type", "start_time", metric("rmse_next_day").alias("rmse"), metric("mae_next_day").alias("mae"),
                                      metric("mape_next_day").alias("mape"), p["data_samples"].cast("long").alias("data_samples"), p["data_start_date"].alias("data_start"),
                                      p["data_end_date"].alias("data_end"))


@query("best_logged_runs", with_ctes(f"""
WITH l AS ({_log_sql()}),
u AS (SELECT model_type, run_id, experiment, rmse_day AS value, CAST(start_time AS TIMESTAMP) AS start_time FROM runs WHERE {_OK}
  UNION ALL SELECT model_type, run_id, experiment, rmse, start_time FROM l)
SELECT model_type, run_id, experiment, value FROM (SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY value, start_time, run_id) AS rn FROM u) x WHERE rn = 1
""", "runs", "forecasts"), ("SNK5", "ST3", "AG6"))
def best_logged_runs(spark, sf):
    """Appended runs rank with the stored ones: best run per model type of both."""
    stored = _runs(spark, sf)
    logged = _run_log(spark, sf).select(*stored.columns)
    return rg.best_run_per_type(stored.withColumn("start_time", F.col("start_time").cast("timestamp")).unionByName(logged))


@query("union_runs", with_ctes(f"""
WITH c AS (SELECT * FROM runs)
SELECT model_type, run_id, experiment, value FROM (
  SELECT model_type, run_id, experiment, rmse_day AS value,
    row_number() OVER (PARTITION BY model_type ORDER BY rmse_day, start_time, run_id) AS rn
  FROM c WHERE {_OK}) y WHERE rn = 1""", "runs"), ("ST3", "SRC5", "AG6"))
def union_runs(spark, sf):
    """Candidates of all experiments in one scan, then the best run per model
    type across them (validity first, no cap)."""
    r = rg.scan_runs(_runs(spark, sf), None, "rmse_next_day", None)
    return rg.best_run_per_type(r)


@query("arima_model_table", None, ("SNK6",))
def arima_model_table(spark, sf):
    """ARIMA models (coefficients and state) saved as Parquet and loaded back."""
    from ..operators import arima as ar
    from ..sources.sinks import load_models, save_models
    from .landing_q import _scratch
    path = _scratch(spark, "arima-model")
    save_models(ar.model_table(fixtures.bars_daily(spark, sf), order=(3, 1, 3)), path)
    return load_models(spark, path)
