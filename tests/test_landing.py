import json

from pyspark.sql import functions as F

from pricelab.sources import landing

GOOD = {"timestamp_utc": "2024-01-02T00:00:00Z", "interval": "1d", "lookback_days": 7, "tickers": ["gc=f"],
        "data": {"gc=f": [{"datetime": "2024-01-02 00:00:00", "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": 1.5,
                           "Volume": 10}]}}


def _docs(spark, items):
    return spark.createDataFrame(items, "file_name string, value string")


def test_malformed_payloads_are_skipped_with_reasons(spark):
    docs = [
        ("f1", json.dumps(GOOD)),
        ("f2", json.dumps({**GOOD, "data": {"error": "boom", "traceback": "..."}})),
        ("f3", json.dumps({**GOOD, "data": [1, 2]})),
        ("f4", json.dumps({**GOOD, "data": {"GC=F": "oops", "tickers": ["x"]}})),
        ("f5", json.dumps({**GOOD, "data": {"GC=F": ["row as text", {"Open": 1.0}]}})),
        ("f6", "{not json"),
    ]
    d = _docs(spark, docs)
    rep = {r["reason"]: r["n"] for r in landing.raw_reject_report(d).collect()}
    assert rep == {"error_payload": 1, "bad_data_type": 1, "bad_rows_type": 1, "metadata_key": 1,
                   "bad_row_type": 1, "missing_datetime": 1, "read_error": 1}
    rows = landing.parse_raw_payload(d).collect()
    assert len(rows) == 1 and rows[0]["ticker"] == "GC=F" and rows[0]["close"] == 1.5


def test_nan_price_becomes_null(spark):
    text = json.dumps(GOOD).replace('"Close": 1.5', '"Close": NaN')
    r = landing.parse_raw_payload(_docs(spark, [("f", text)])).collect()[0]
    assert r["close"] is None


def test_same_key_in_two_files_last_file_wins(spark):
    later = json.loads(json.dumps(GOOD))
    later["data"]["gc=f"][0]["Close"] = 9.0
    d = _docs(spark, [("raw/2024/01/02/a_T010000Z.json", json.dumps(GOOD)),
                      ("raw/2024/01/02/a_T020000Z.json", json.dumps(later))])
    r = landing.dedup_last(landing.parse_raw_payload(d)).collect()
    assert len(r) == 1 and r[0]["close"] == 9.0


def test_process_date_forced_and_fallback(spark):
    rows = landing.parse_raw_payload(_docs(spark, [("f", json.dumps(GOOD))]))
    assert landing.select_process_date(rows, "2024-01-05", forced=True).count() == 0
    assert landing.select_process_date(rows, "2024-01-05", forced=False).count() == 1
    assert landing.select_process_date(rows, "2024-01-02", forced=True).count() == 1


def test_payload_roundtrip(spark):
    bars = spark.createDataFrame([("X", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 7)],
                                 "series string, dt string, open double, high double, low double, close double, volume long")
    bars = bars.withColumn("dt", F.col("dt").cast("date"))
    rows = landing.parse_raw_payload(landing.to_raw_payload(bars)).collect()
    assert [(r["ticker"], r["datetime"], r["close"], r["volume"]) for r in rows] == [("X", "2024-01-02 00:00:00", 1.5, 7)]


def test_stream_equals_batch(spark, scratch):
    from pricelab.streaming.landing_stream import read_processed, run_landing_stream
    later = json.loads(json.dumps(GOOD))
    later["data"]["gc=f"][0]["Close"] = 9.0
    root, table = f"{scratch}/raw", f"{scratch}/table"
    spark.createDataFrame([(json.dumps(GOOD),)], "value string").write.text(f"{root}/20240102T010000Z")
    run_landing_stream(spark, root, table, f"{scratch}/ckpt")
    spark.createDataFrame([(json.dumps(later),)], "value string").write.text(f"{root}/20240102T020000Z")
    run_landing_stream(spark, root, table, f"{scratch}/ckpt")
    got = read_processed(spark, table).collect()
    assert len(got) == 1 and got[0]["close"] == 9.0


def test_parse_process_date():
    import pytest
    assert landing.parse_process_date("2024-01-02") == ("2024-01-02", True)
    assert landing.parse_process_date(None, today="2024-03-04") == ("2024-03-04", False)
    with pytest.raises(ValueError):
        landing.parse_process_date("2024/01/02")


def test_processed_daily_rerun_overwrites_only_its_day(spark, scratch):
    def rows(day, close):
        return spark.createDataFrame([(f"{day} 00:00:00", "GC=F", 1.0, 2.0, 0.5, close, 3)],
                                     "datetime string, ticker string, open double, high double, low double, "
                                     "close double, volume long")
    from pricelab.plans.landing_job import read_processed_daily
    out = f"{scratch}/processed"
    landing.write_processed_daily(rows("2024-01-02", 1.0), out)
    landing.write_processed_daily(rows("2024-01-03", 2.0), out)
    landing.write_processed_daily(rows("2024-01-02", 5.0), out)
    got = {r["datetime"][:10]: r["close"] for r in read_processed_daily(spark, out).collect()}
    assert got == {"2024-01-02": 5.0, "2024-01-03": 2.0}
