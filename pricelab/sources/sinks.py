"""Sinks: SNK1 bars/features, SNK6 model tables (SNK2 landing.write_processed_daily,
SNK3 landing.to_raw_payload, SNK4 forecasts.write_forecasts, SNK5 registry.log_runs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.arima import MODEL_COLUMNS


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """SNK1: bars or features; CSV gets a header (the reference writes CSV with the index)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def save_models(models: DataFrame, path: str, trained_date: str | None = None) -> None:
    """SNK6: the fitted models are a table, one row per series with coefficients, state and
    training date (``arima.model_table``); Parquet, overwritten per training run."""
    models.withColumn("trained_date", F.lit(trained_date).cast("string")).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """A saved model table; one without the state that forecasts need is refused."""
    models = spark.read.parquet(path)
    missing = {c.strip().split(" ")[0] for c in MODEL_COLUMNS.split(", ")} - set(models.columns)
    if missing:
        raise ValueError(f"{path} is no model table: it has no {sorted(missing)}")
    return models


def save_tree_models(spark: SparkSession, models: dict, path: str, features: list[str], target: str = "relative") -> None:
    """SNK6 for trees: one Spark ML model per horizon, and what they were trained on."""
    for horizon, model in models.items():
        model.write().overwrite().save(f"{path}/horizon={horizon}")
    meta = [(int(h), type(m).__module__ + "." + type(m).__name__, list(features), target) for h, m in models.items()]
    spark.createDataFrame(meta, "horizon int, kind string, features array<string>, target string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_tree_models(spark: SparkSession, path: str) -> tuple[dict, list[str], str]:
    """``({horizon: model}, features, target)`` as saved."""
    from importlib import import_module

    rows = spark.read.parquet(f"{path}/meta").collect()       # one row a horizon
    models = {}
    for r in rows:
        module, _, name = r["kind"].rpartition(".")
        if not module.startswith("pyspark.ml."):
            raise ValueError(f"unknown model class {r['kind']}")
        models[r["horizon"]] = getattr(import_module(module), name).load(f"{path}/horizon={r['horizon']}")
    return models, list(rows[0]["features"]), rows[0]["target"]
