"""features_ticks: short frames joined to long ones, rounding in doubles, methods that the JVM compiles."""
import contextlib
import io
import math
import random
import re
import statistics

from pyspark.sql import functions as F

from pricelab.catalog.features_q import _rounded
from pricelab.catalog.registry import round_df
from pricelab.operators import features as fe
from pricelab.operators.layout import series_layout

from conftest import bars_frame


def test_long_frames_equal_plain_statistics(spark):
    rng = random.Random(3)
    closes = [None if i == 70 else 5.0 if 80 <= i < 150 else round(rng.uniform(1, 9e4), 2) for i in range(220)]
    df = spark.createDataFrame([("A", i, c) for i, c in enumerate(closes)], "series string, dt int, close double")
    lay = series_layout(df, order="dt", lookback=fe.MAX_LOOKBACK)
    got = {r.dt: r for r in fe.two_stage(lay, df, lambda W1: [], lambda W2, f1: fe.rolling_columns(f1, W2, with_ema=False)).collect()}
    assert any(k in fe.BLOCKS for k in fe.ROLL_WINDOWS)
    for i in range(len(closes)):
        for k in fe.ROLL_WINDOWS:
            own = closes[max(0, i - k + 1):i + 1]
            names = [got[i][f"roll_{n}_{k}"] for n in ("mean", "std", "min", "max")]
            if len(own) < k or None in own:
                assert names == [None] * 4
                continue
            want = [statistics.fmean(own), statistics.stdev(own), min(own), max(own)]
            assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(names, want)), (i, k, names, want)
            if len(set(own)) == 1:
                assert names[1] == 0.0          # quotients by a range of 0 depend on it


def test_long_frames_are_no_sliding_frames(spark):
    out = fe.create_features(bars_frame(spark, range(1, 300)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    widths = {int(x) + 1 for x in re.findall(r"RowFrame, -(\d+), currentrow", plan)}
    assert widths == {3, 5, 7, 10}


def test_oversized_methods_are_not_used(spark):
    """The widest stage of the feature table generates a method above 8000 bytes, which the JVM only
    interprets: a plan of it sets the limit from which Spark takes small methods instead."""
    ticks = bars_frame(spark, range(1, 300)).select("series", "dt", "close")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            _rounded(fe.create_features(ticks)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", text.getvalue())) > 8000
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_rounding_equals_round(spark):
    rng = random.Random(4)
    values = [None, 0.0, -0.0, math.inf, -math.inf, math.nan, 1e300, -1e300, 5e-324, 0.5, 2.5, -2.5, 1.00005, 1.00015, 2.675, -1.00005, 123456.78905,
              99999999.99995, 1e11, 1e15 + 0.5, -0.00004, -0.00006, 4.35, 0.1 + 0.2]
    values += [s * rng.randint(1, 10 ** 9) / 10 ** rng.randint(0, 11) for s in (1, -1) for _ in range(3000)]
    values += [round(rng.uniform(-9e5, 9e5), d) + tie for d in (4, 7, 9) for tie in (0.5 * 10 ** -d, 0.0) for _ in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for d in (0, 4, 7, 9):
        a = {r.i: r.v for r in round_df(df, {"v": d}).collect()}
        b = {r.i: r.v for r in df.select("i", F.round("v", d).alias("v")).collect()}
        assert all(repr(a[i]) == repr(b[i]) for i in b), [(values[i], a[i], b[i]) for i in b if repr(a[i]) != repr(b[i])][:5]
    mixed = spark.createDataFrame([(1, 2.5)], "i int, v float")
    assert round_df(mixed, {"v": 1}).dtypes == [("i", "int"), ("v", "float")]
