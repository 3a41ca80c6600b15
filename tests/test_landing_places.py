"""Landing: places of refused pieces, order inside files, split day writes, dated folders, streams per table."""

import glob
import json
import os

from pyspark.sql import functions as F

from pricelab.sources import landing
from pricelab.streaming.landing_stream import read_processed, run_landing_stream


def row(close, day="2024-01-02"):
    return {"datetime": f"{day} 00:00:00", "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": close, "Volume": 10}


def doc(data):
    return json.dumps({"timestamp_utc": "x", "interval": "1d", "lookback_days": 7, "tickers": ["GC=F"], "data": data})


def test_quarantine_names_place_and_piece(spark):
    docs = [("f1", doc(None)), ("f2", '{"interval":"1d"}'), ("f3", doc({"GC=F": [None, row(1.0), 7, {"datetime": None}], "error_rate": "x"})), ("f4", "broken"),
            ("f5", doc({"error": "no", "tickers": ["GC=F"]})), ("f6", doc({"GC=F": []})), ("f7", doc({}))]
    d = spark.createDataFrame(docs, "file_name string, value string")
    got = {(r.file_name, r.ticker, r.key_pos, r.row_pos, r.reason) for r in landing.raw_rejects(d).collect()}
    assert got == {("f1", None, None, None, "bad_data_type"), ("f3", "GC=F", 0, 0, "bad_row_type"), ("f3", "GC=F", 0, 2, "bad_row_type"),
                   ("f3", "GC=F", 0, 3, "missing_datetime"), ("f3", "error_rate", 1, None, "bad_rows_type"), ("f4", None, None, None, "read_error"),
                   ("f5", None, None, None, "error_payload")}
    pieces = {(r.file_name, r.row_pos): r.piece for r in landing.raw_rejects(d).collect()}
    assert pieces["f4", None] == "broken" and pieces["f3", 0] == "null" and pieces["f3", 2] == "7" and pieces["f3", None] == "x"
    status = {r.file_name: r.status for r in landing.has_data(d).collect()}
    assert status == {"f1": 207, "f2": 207, "f3": 200, "f4": 207, "f5": 207, "f6": 207, "f7": 207}


def test_last_line_of_a_file_wins(spark, scratch):
    """Also where the file is read in several splits, in any order of partitions."""
    lines = [doc({"GC=F": [row(float(i))], "pad": "p" * 3000}) for i in range(200)]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(scratch + "/in")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        docs = landing.scan_raw_landing(spark, scratch + "/in", glob="*.txt", one_doc_per_line=True)
        assert docs.rdd.getNumPartitions() > 4
        best = landing.dedup_last(landing.parse_raw_payload(docs)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.close for r in best] == [199.0]


def processed(spark, rows):
    return spark.createDataFrame([(f"{d} 00:00:{i % 60:02d}", f"T{i:04d}", 1.0, 2.0, 0.5, v, 3) for d, i, v in rows],
                                 "datetime string, ticker string, open double, high double, low double, close double, volume long")


def day_files(path, day):
    return sorted(glob.glob(f"{path}/date={day}/*.csv"))


def test_a_large_day_is_split_and_replaced_whole(spark, scratch):
    from pricelab.plans.landing_job import read_processed_daily
    path = scratch + "/p"
    big = [("2024-01-02", i, 1.0) for i in range(500)] + [("2024-01-03", i, 1.0) for i in range(20)]
    landing.write_processed_daily(processed(spark, big), path, rows_per_file=60)
    files = day_files(path, "2024-01-02")
    assert len(files) >= 6
    order = [line.split(",")[1] for f in files for line in open(f).read().splitlines()[1:]]
    assert order == sorted(order) and len(order) == 500 and all(open(f).readline().startswith("datetime,ticker,open") for f in files)
    other = {f: os.stat(f).st_mtime_ns for f in day_files(path, "2024-01-03")}
    landing.write_processed_daily(processed(spark, [("2024-01-02", i, 9.0) for i in range(7)]), path, rows_per_file=60)
    got = read_processed_daily(spark, path).groupBy(F.substring("datetime", 1, 10).alias("d")).agg(F.count("*").alias("n"), F.max("close").alias("c")).collect()
    assert {(r.d, r.n, r.c) for r in got} == {("2024-01-02", 7, 9.0), ("2024-01-03", 20, 1.0)}
    assert {f: os.stat(f).st_mtime_ns for f in day_files(path, "2024-01-03")} == other


def test_dated_landing_is_one_file_a_document(spark, scratch):
    bars = spark.createDataFrame([(s, f"2024-0{m}-10", 1.0, 2.0, 0.5, 1.5, 7) for s in ("A", "B", "C") for m in (1, 2)],
                                 "series string, dt string, open double, high double, low double, close double, volume long").withColumn("dt", F.col("dt").cast("date"))
    docs = landing.to_raw_payload(bars)
    for day in ("2024-01-31", "2024-02-29"):
        landing.write_landing(docs, scratch + "/raw", day)
    assert len(glob.glob(scratch + "/raw/2024/01/31/prices_20240131T000000Z/part-*.txt")) == 3
    got = landing.scan_raw_landing(spark, scratch + "/raw", "2024-02-29", glob="*.txt")
    assert got.count() == 3 and all("/2024/02/29/" in f for f in got.inputFiles())
    later = landing.to_raw_payload(bars.withColumn("close", F.lit(9.0)), run_time="120000")
    landing.write_landing(later, scratch + "/raw", "2024-02-29", "120000")
    best = landing.dedup_last(landing.parse_raw_payload(landing.scan_raw_landing(spark, scratch + "/raw", "2024-02-29", glob="*.txt"))).collect()
    assert {r.close for r in best} == {9.0} and len(best) == 3


def test_two_tables_from_one_root(spark, scratch):
    os.makedirs(scratch + "/raw/a")
    open(scratch + "/raw/a/1.txt", "w").write(doc({"GC=F": [row(1.0), row(2.0, "2024-01-05")]}))
    os.makedirs(scratch + "/empty")                     # a first write that failed leaves such a folder
    for table in ("/one", "/empty"):
        run_landing_stream(spark, scratch + "/raw", scratch + table, wholetext=True)
        assert {(r.datetime[:10], r.close) for r in read_processed(spark, scratch + table).collect()} == {("2024-01-02", 1.0), ("2024-01-05", 2.0)}
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(scratch + "/one/date=2024-01-05/*.parquet")}
    open(scratch + "/raw/a/2.txt", "w").write(doc({"GC=F": [row(7.0)]}))
    run_landing_stream(spark, scratch + "/raw", scratch + "/one", wholetext=True)
    assert {(r.datetime[:10], r.close) for r in read_processed(spark, scratch + "/one").collect()} == {("2024-01-02", 7.0), ("2024-01-05", 2.0)}
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(scratch + "/one/date=2024-01-05/*.parquet")} == kept
