"""Lifecycle C: bars -> features -> split -> scale -> boosted trees (day, week)
-> train/test metrics; latest feature row -> next-day / next-week forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import ml
from ..session import cut_lineage


def train_and_score(bars: DataFrame, kind: str = "gbt", optimized: bool = True) -> DataFrame:
    f = cut_lineage(ev.time_split(fe.create_features(bars), 0.8))
    cols = list(fe.OPTIMIZED_FEATURES) if optimized else fe.feature_columns(f.drop("split", "idx", "n_split"))
    f = ml.standard_scale(f, cols, fit_on=F.col("split") == "train", suffix="_z")
    return ml.train_test_metrics(f, [c + "_z" for c in cols], kind)
