import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[2]").appName("pricelab-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="pricelab-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="pricelab-test-")


def bars_frame(spark, closes, series="A", start="2024-01-01", hl_spread=1.0):
    import datetime as dt
    d0 = dt.date.fromisoformat(start)
    rows = [(series, d0 + dt.timedelta(days=i), float(c) - 0.5, float(c) + hl_spread, float(c) - hl_spread,
             float(c), 100 + i) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "series string, dt date, open double, high double, low double, "
                                       "close double, volume long")
