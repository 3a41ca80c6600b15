"""Results do not depend on size switches, and nothing is dropped without saying so."""

import datetime as dt
import json
import os

import pytest

from pricelab.operators.ema import add_ema, ema_lookback
from pricelab.operators.layout import series_layout
from pricelab.sources import bars, landing

from conftest import bars_frame


def test_ema_needs_its_lookback_in_halo_mode(spark):
    b = bars_frame(spark, [100 + (i * 37 % 11) for i in range(4000)])
    with pytest.raises(ValueError, match="looks back"):
        add_ema(series_layout(b, lookback=0, mode="halo", chunk_rows=400))
    plain = add_ema(series_layout(b, mode="plain")).orderBy("dt").toPandas()
    lay = series_layout(b, lookback=ema_lookback(), mode="halo", chunk_rows=1500)
    halo = lay.finish(add_ema(lay)).orderBy("dt").toPandas()
    for c in ("ema_7", "ema_50", "macd", "macd_signal"):
        assert abs(plain[c] - halo[c]).max() < 1e-9


def _document(root, day, **fields):
    path = os.path.join(root, *day.split("-"))
    os.makedirs(path, exist_ok=True)
    row = [{"datetime": f"{day}T00:00:00", "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": 1.5, "Volume": 3.0}]
    env = {"timestamp_utc": day, "interval": "1d", "lookback_days": 7, "tickers": ["GC=F"], "data": json.dumps({"GC=F": row})} | fields
    with open(os.path.join(path, "gold.json"), "w") as f:
        json.dump(env, f)


def test_unrelated_field_types_keep_the_document(spark, scratch):
    _document(scratch, "2024-01-01", lookback_days="seven")
    _document(scratch, "2024-01-02", tickers="GC=F")
    docs = landing.scan_raw_landing(spark, scratch, glob="*.json")
    assert landing.parse_raw_payload(docs).count() == 2


def test_stream_reads_dated_folders_and_raises_on_a_broken_table(spark, scratch):
    from pricelab.streaming.landing_stream import read_processed, run_landing_stream
    raw, table = os.path.join(scratch, "raw"), os.path.join(scratch, "table")
    _document(raw, "2024-01-01")
    _document(raw, "2024-02-03")
    run_landing_stream(spark, raw, table, os.path.join(scratch, "c1"), wholetext=True, glob="*.json")
    assert read_processed(spark, table).count() == 2
    broken = os.path.join(scratch, "broken")
    os.makedirs(broken)
    spark.range(3).write.mode("overwrite").parquet(broken)
    with pytest.raises(Exception):
        run_landing_stream(spark, raw, broken, os.path.join(scratch, "c2"), wholetext=True, glob="*.json")
    assert spark.read.parquet(broken).count() == 3


def test_csv_with_two_time_columns_and_two_tickers(spark, scratch):
    path = os.path.join(scratch, "two.csv")
    with open(path, "w") as f:
        f.write("Date,datetime,Open,High,Low,Close,Volume\n2020-01-01,2024-05-06,1,2,0.5,1.5,9\n")
    assert bars.read_bars_csv(spark, path).first()["dt"].date() == dt.date(2024, 5, 6)
    with pytest.raises(ValueError, match="more than one column"):
        bars.normalize_columns(spark.createDataFrame([(1.0, 2.0)], "`Close_GC=F` double, `Close_SI=F` double"))
