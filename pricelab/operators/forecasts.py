"""Forecast payloads (FM11, SNK4, SRC6, PF15).

Payload: ``series, as_of, model_name, model_type,
predictions struct<tomorrow, day_after_tomorrow>, note`` (one per series).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values used by the reference's payload writer and reader.
DEFAULT_MODEL_NAME = "arima_gold_price_production"
DEFAULT_MODEL_TYPE = "ARIMA"
DEFAULT_NOTE = "Predictions generated daily. Model is retrained separately."

PAYLOAD_SCHEMA = ("series string, as_of string, model_name string, model_type string, "
                  "predictions struct<tomorrow:double,day_after_tomorrow:double>, note string")


def daily_payload(fc: DataFrame, model_name: str = DEFAULT_MODEL_NAME, model_type: str = DEFAULT_MODEL_TYPE,
                  note: str = DEFAULT_NOTE, series: str = "series") -> DataFrame:
    """FM11: long forecasts (series, as_of, horizon, forecast) for horizons 1
    and 2 -> one payload row per series."""
    g = fc.where(F.col("horizon").isin(1, 2)).groupBy(series).agg(
        F.max("as_of").alias("_as_of"),
        F.max(F.when(F.col("horizon") == 1, F.col("forecast"))).alias("tomorrow"),
        F.max(F.when(F.col("horizon") == 2, F.col("forecast"))).alias("day_after_tomorrow"))
    return g.select(series, F.col("_as_of").cast("string").alias("as_of"), F.lit(model_name).alias("model_name"),
                    F.lit(model_type).alias("model_type"),
                    F.struct("tomorrow", "day_after_tomorrow").alias("predictions"), F.lit(note).alias("note"))


def to_json_lines(payload: DataFrame) -> DataFrame:
    return payload.select(F.to_json(F.struct(*payload.columns)).alias("value"))


def write_forecasts(payload: DataFrame, path: str) -> None:
    """SNK4: JSON lines at ``path``; overwrite = last write wins."""
    to_json_lines(payload).write.mode("overwrite").text(path)


def scan_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: read payload JSON with a declared schema."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def parse_payload(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", PAYLOAD_SCHEMA).alias("p")).select("p.*")


def forecast_long(payload: DataFrame) -> DataFrame:
    """PF15: payload -> (series, as_of, model_type, model_name, note,
    horizon_days, price) for days 1 and 2; missing metadata gets defaults."""
    rows = F.inline(F.array(
        F.struct(F.lit(1).alias("horizon_days"), F.col("predictions.tomorrow").alias("price")),
        F.struct(F.lit(2).alias("horizon_days"), F.col("predictions.day_after_tomorrow").alias("price"))))
    return payload.select(
        "series", "as_of", F.coalesce("model_type", F.lit(DEFAULT_MODEL_TYPE)).alias("model_type"),
        F.coalesce("model_name", F.lit(DEFAULT_MODEL_NAME)).alias("model_name"),
        F.coalesce("note", F.lit(DEFAULT_NOTE)).alias("note"), rows)
