"""Skew-safe per-group selection helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 64
LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, salt_on: str | None = None,
          rank_col: str = "rank", salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (a total order: end with a unique key).

    Up to ``LIMIT_KEY`` ranks Spark itself keeps only k rows per group and task before it
    shuffles (window group limit), so a group holding a third of all rows reaches one task as
    k rows per map task. Beyond that, and if ``salt_on`` is given, the same is done in two phases:
    top-k inside (group, salt) slices, then over the at most ``salt_buckets * k`` survivors."""
    limit = int(df.sparkSession.conf.get(LIMIT_KEY, "1000"))
    if salt_on is not None and k > limit:
        salt = F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salt_buckets))
        w1 = Window.partitionBy(*group, salt).orderBy(*order)
        df = df.withColumn("_rk1", F.row_number().over(w1)).where(F.col("_rk1") <= k).drop("_rk1")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
