"""Reference-shaped tables derived from the given parquet tables.

Each builder has a Spark form (used by the operators) and an equal SQL form
(used as a CTE by the DuckDB oracle). Every builder reads whole tables: no row
subsets, so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bars import resample_ohlcv
from .tables import table


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars, one series per order priority (5 series)."""
    return resample_ohlcv(table(spark, sf_dir, "orders"), ts="o_orderdate", price="o_totalprice",
                          series="o_orderpriority", interval="1 day", tie="o_orderkey")


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLCV bars, one series per event type (5 series)."""
    return resample_ohlcv(table(spark, sf_dir, "events"), ts="ts", price="value",
                          series="event_type", interval="1 hour", tie="event_id")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long price series: every order is a tick of its priority series.

    ``(dt, seq)`` is the unique order key (the order date repeats)."""
    return (table(spark, sf_dir, "orders")
            .select(F.col("o_orderpriority").alias("series"),
                    F.col("o_orderdate").alias("dt"),
                    F.col("o_orderkey").alias("seq"),
                    F.col("o_totalprice").alias("close")))


def runs_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records, one per order: NULL metrics and runs without a model included."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.when(F.col("o_orderstatus") == "F", "arima")
         .when(F.col("o_orderstatus") == "O", "xgboost")
         .otherwise("random_forest").alias("model_type"),
        F.col("o_orderdate").alias("start_time"),
        F.when(k % 11 != 0, F.col("o_totalprice") / 1000).alias("rmse_day"),
        (F.col("o_totalprice") / 1300).alias("mae_day"),
        (F.col("o_custkey") % 10).cast("double").alias("mape_day"),
        F.when(k % 3 == 1, "model/MLmodel").when(k % 3 == 2, "arima_model/MLmodel").alias("model_path"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run table in its model form: metric/param maps and an artifact list."""
    f = runs_flat(spark, sf_dir)
    metrics = F.map_from_arrays(
        F.array(F.lit("rmse_next_day"), F.lit("mae_next_day"), F.lit("mape_next_day")),
        F.array("rmse_day", "mae_day", "mape_day"))
    metrics = F.map_filter(metrics, lambda k, v: v.isNotNull())
    params = F.create_map(F.lit("model_type"), F.col("model_type"))
    artifacts = F.when(F.col("model_path").isNotNull(),
                       F.array(F.col("model_path"), F.lit("metrics.json"))).otherwise(F.array(F.lit("metrics.json")))
    return f.select("run_id", "experiment", "model_type", "start_time",
                    metrics.alias("metrics"), params.alias("params"), artifacts.alias("artifacts"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered versions: every run with a model, numbered per model by start time."""
    from ..operators.layout import POS, with_positions
    r = runs_flat(spark, sf_dir).where(F.col("model_path").isNotNull()).select("experiment", "start_time", "run_id")
    # Version = position in start order per model; positions are skew-safe
    # (an experiment may hold a large share of all runs).
    p = with_positions(r, "experiment", ["start_time", "run_id"])
    v = (F.col(POS) + 1).cast("int")
    return p.select(F.col("experiment").alias("model_name"), v.alias("version"), "run_id") \
        .withColumn("aliases", F.when(F.col("version") % 7 == 0, F.array(F.lit("Production")))
                    .otherwise(F.array().cast("array<string>")))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two SQL-able predictors per daily series (naive, 5-day mean), horizon 1."""
    from ..operators.layout import OWN, series_layout
    b = bars_daily(spark, sf_dir)
    lay = series_layout(b, lookback=5)
    w = lay.window()
    keep = [OWN] if lay.halo else []
    p = lay.finish(lay.df.select("series", "dt", "close", *keep, F.lag("close").over(w).alias("_naive"),
                                 F.avg("close").over(w.rowsBetween(-5, -1)).alias("_ma5")))
    naive = p.select("series", "dt", F.lit("naive").alias("model"), F.lit(1).alias("horizon"),
                     F.col("close").alias("actual"), F.col("_naive").alias("predicted"))
    ma5 = p.select("series", "dt", F.lit("ma5").alias("model"), F.lit(1).alias("horizon"),
                   F.col("close").alias("actual"), F.col("_ma5").alias("predicted"))
    return naive.unionByName(ma5)


# ---------------------------------------------------------------------------
# SQL forms (DuckDB oracle CTEs). Same rows as the Spark builders above.
# ---------------------------------------------------------------------------

SQL_BARS_DAILY = """
select o_orderpriority as series, cast(o_orderdate as date) as dt,
  min_by(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
  max_by(o_totalprice, o_orderkey) as close, count(*) as volume
from orders group by o_orderpriority, cast(o_orderdate as date)"""

SQL_BARS_HOURLY = """
select event_type as series, date_trunc('hour', ts) as dt,
  min_by(value, event_id) as open, max(value) as high, min(value) as low,
  max_by(value, event_id) as close, count(*) as volume
from events group by event_type, date_trunc('hour', ts)"""

SQL_TICKS = """
select o_orderpriority as series, o_orderdate as dt, o_orderkey as seq, o_totalprice as close from orders"""

SQL_RUNS = """
select cast(o_orderkey as varchar) as run_id, o_orderpriority as experiment,
  case when o_orderstatus = 'F' then 'arima' when o_orderstatus = 'O' then 'xgboost' else 'random_forest' end as model_type,
  o_orderdate as start_time,
  case when o_orderkey % 11 <> 0 then o_totalprice / 1000 end as rmse_day,
  o_totalprice / 1300 as mae_day, cast(o_custkey % 10 as double) as mape_day,
  case when o_orderkey % 3 = 1 then 'model/MLmodel' when o_orderkey % 3 = 2 then 'arima_model/MLmodel' end as model_path
from orders"""

SQL_VERSIONS = """
select model_name, version, run_id,
  case when version % 7 = 0 then ['Production'] else []::varchar[] end as aliases
from (select experiment as model_name,
  cast(row_number() over (partition by experiment order by start_time, run_id) as int) as version, run_id
  from runs where model_path is not null) v"""

SQL_FORECASTS = """
select series, dt, 'naive' as model, 1 as horizon, close as actual,
  lag(close) over (partition by series order by dt) as predicted from bars_daily
union all
select series, dt, 'ma5', 1, close,
  avg(close) over (partition by series order by dt rows between 5 preceding and 1 preceding) from bars_daily"""

_CTES = {
    "bars_daily": SQL_BARS_DAILY,
    "bars_hourly": SQL_BARS_HOURLY,
    "ticks": SQL_TICKS,
    "runs": SQL_RUNS,
    "versions": SQL_VERSIONS,
    "forecasts": SQL_FORECASTS,
}
_DEPS = {"versions": ["runs"], "forecasts": ["bars_daily"]}


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture CTEs it names (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} as ({_CTES[n]}\n)" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
