"""Positions by value in both layouts, shapes of values that defeat fixed-width buckets, and the inverse normal."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.functions.stats_math import SparkOps, norm_ppf, ppf_tail_root
from pricelab.operators import stats as st
from pricelab.operators.layout import POS
from pricelab.operators.positions import PART, quantiles, value_positions

RNG = np.random.default_rng(0)
SHAPES = {"returns": RNG.normal(0, 1e-3, 6000), "log_normal": np.exp(RNG.normal(0, 4, 6000)),
          "third_equal": np.where(np.arange(6000) % 3 == 0, 0.0, RNG.normal(size=6000)), "constant": np.full(6000, 2.5)}


def frame(spark, x):
    rows = [("A", i, float(v)) for i, v in enumerate(x)] + [("B", i, float(i % 7)) for i in range(50)] + [("C", 0, 1.5), ("D", 0, None), ("D", 1, float("nan"))]
    return spark.createDataFrame(rows, "series string, dt int, v double")


@pytest.mark.parametrize("shape", list(SHAPES))
def test_positions_and_quantiles(spark, shape):
    x = SHAPES[shape]
    df = frame(spark, x)
    good = df.where("v is not null and not isnan(v)")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    for mode in ("plain", "halo:500"):
        got = {(r.series, r.q): r.value for r in quantiles(df, "v", probs, ["series"], mode).collect()}
        for name, values in (("A", x), ("B", [i % 7 for i in range(50)]), ("C", [1.5])):
            for q in probs:
                assert got[name, q] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-15), (mode, name, q)
        assert ("D", 0.5) not in got
        p = value_positions(good, ["series"], ["v", "dt"], mode).where("series = 'A'").orderBy("v", "dt").collect()
        assert [r[POS] for r in p] == list(range(6000)) and {r["_n"] for r in p} == {6000}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_no_partition_above_twice_the_chunk(spark, shape, monkeypatch):
    """What one task sorts is bounded by the chunk size, whatever the values."""
    import pricelab.operators.positions as P
    seen = []

    def spy(df):
        from pricelab.session import cut_lineage
        out = cut_lineage(df)
        seen.append(out.groupBy(PART).count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(P, "cut_lineage", spy)
    value_positions(frame(spark, SHAPES[shape]).where("v is not null"), ["series"], ["v", "dt"], "halo:500").count()
    assert seen and max(seen) <= 1000


def test_describe_is_one_long_pass(spark):
    df = frame(spark, SHAPES["log_normal"]).withColumn("w", F.col("dt").cast("long"))
    for cols in (["v", "w"], ["w"]):
        got = {(r.series, r.column): r for r in st.describe(df.where("series in ('A', 'B')"), cols, digits=None).collect()}
        for c, values in (("v", SHAPES["log_normal"]), ("w", np.arange(6000))):
            if c in cols:
                r = got["A", c]
                assert r["count"] == 6000 and r.p50 == pytest.approx(np.median(values)) and r["std"] == pytest.approx(np.std(values, ddof=1))
    empty = {r.series: r for r in st.describe(df.where("series = 'D' and dt = 0"), ["v"]).collect()}["D"]
    assert empty["count"] == 0 and empty.p50 is None


def test_inverse_normal_known_values(spark):
    p = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.075, 0.3, 0.5, 0.6915, 0.925, 0.9251, 0.99, 1 - 1e-12]
    df = spark.createDataFrame([(x,) for x in p], "p double").withColumn("r", ppf_tail_root(F.col("p")))
    got = [r.x for r in df.select("p", norm_ppf(F.col("p"), F.col("r"), SparkOps).alias("x")).collect()]
    for a, x in zip(p, got):
        assert x == pytest.approx(NormalDist().inv_cdf(a), rel=1e-14, abs=1e-15)
    assert got[p.index(0.99)] == pytest.approx(2.3263478740408408, rel=1e-14)
