"""Landing / ingest queries (lifecycle A) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection as sel
from ..session import cut_lineage
from ..sources import fixtures, landing
from ..sources.fixtures import with_ctes
from ..sources.tables import table
from .registry import query

_DT = "strftime(dt, '%Y-%m-%d %H:%M:%S')"
_PROCESSED = f"{_DT} AS datetime, upper(series) AS ticker, open, high, low, close, volume"


def _docs(spark, sf):
    return landing.to_raw_payload(fixtures.bars_daily(spark, sf))


def _rows(spark, sf):
    return landing.parse_raw_payload(_docs(spark, sf))


@query("raw_roundtrip", with_ctes(f"SELECT {_PROCESSED} FROM bars_daily", "bars_daily"),
       ("SNK3", "SRC3", "PF2", "SC7"))
def raw_roundtrip(spark, sf):
    """Bars -> JSON envelopes -> parsed candidate rows (exact round trip)."""
    return landing.processed_daily(_rows(spark, sf))


QUERIES_DEDUP_SQL = with_ctes(
    f"SELECT {_DT} AS datetime, upper(series) AS ticker, open, high, low, "
    "CASE WHEN volume > 1 THEN high ELSE close END AS close, volume FROM bars_daily", "bars_daily")


@query("dedup_last", QUERIES_DEDUP_SQL, ("AG8", "ST1"))
def dedup_last(spark, sf):
    """Two landings of the same days; the later one revises close where volume > 1.
    Last file wins per (ticker, datetime)."""
    bars = fixtures.bars_daily(spark, sf)
    first = landing.to_raw_payload(bars)
    revised = landing.to_raw_payload(bars.where(F.col("volume") > 1).withColumn("close", F.col("high")),
                                     run_time="120000")
    rows = landing.parse_raw_payload(first.unionByName(revised))
    return landing.processed_daily(landing.dedup_last(rows))


QUERIES_SELECT_DATE_SQL = with_ctes(
    f"SELECT {_PROCESSED} FROM bars_daily WHERE CAST(dt AS DATE) = (SELECT max(CAST(dt AS DATE)) FROM bars_daily)",
    "bars_daily")


@query("select_process_date", QUERIES_SELECT_DATE_SQL, ("PF5", "SC5", "SC6"))
def select_process_date(spark, sf):
    """Requested date absent and not forced -> the latest available date."""
    return landing.processed_daily(landing.select_process_date(_rows(spark, sf), "2099-01-01", forced=False))


@query("available_dates", with_ctes(
    "SELECT strftime(dt, '%Y-%m-%d') AS date, count(*) AS n_rows, "
    "strftime(dt, '%Y-%m-%d') = (SELECT strftime(max(dt), '%Y-%m-%d') FROM bars_daily) AS is_latest "
    "FROM bars_daily GROUP BY 1", "bars_daily"), ("AG9",))
def available_dates(spark, sf):
    return landing.available_dates(_rows(spark, sf))


@query("has_data", with_ctes(
    "SELECT DISTINCT 'raw/' || strftime(last_day(dt), '%Y/%m/%d') || '/prices_' || strftime(last_day(dt), '%Y%m%d') "
    "|| 'T000000Z_' || series || '.json' AS file_name, true AS has_data, 200 AS status FROM bars_daily",
    "bars_daily"), ("AG10",))
def has_data(spark, sf):
    return landing.has_data(_docs(spark, sf))


_SHAPE = "(CAST(strftime(dt, '%m') AS INTEGER) % 8)"


def _malformed(docs):
    """Real documents, most of them damaged in a way that the month of their key names."""
    v, shape = F.col("value"), F.regexp_extract("file_name", "raw/[0-9]+/([0-9]+)/", 1).cast("int") % 8
    rows = lambda old, new: F.replace(v, F.lit(old), F.lit(new))
    damaged = (F.when(shape == 1, F.concat(F.lit("{truncated "), v))
               .when(shape == 2, F.regexp_replace(v, '"data":.*', '"data":{"error":"no answer","traceback":"...","tickers":["x"]}}'))
               .when(shape == 3, F.regexp_replace(v, '"data":.*', '"data":[1,2]}'))
               .when(shape == 4, F.regexp_replace(v, '"data":.*', '"data":null}'))
               .when(shape == 5, rows('"data":{', '"data":{"tickers":["x"],"OTHER":"no list",'))
               .when(shape == 6, rows(":[{", ':["text",null,{'))
               .when(shape == 7, rows('"datetime":', '"when":')).otherwise(v))
    return docs.select("file_name", damaged.alias("value"))


@query("raw_quarantine", with_ctes(f"""
WITH d AS (SELECT {_SHAPE} AS shape, strftime(dt, '%Y%m') AS m, series, count(*) AS n FROM bars_daily GROUP BY ALL),
r AS (
  SELECT 'read_error' AS reason, 1 AS k FROM d WHERE shape = 1
  UNION ALL SELECT 'error_payload', 1 FROM d WHERE shape = 2
  UNION ALL SELECT 'bad_data_type', 1 FROM d WHERE shape IN (3, 4)
  UNION ALL SELECT 'metadata_key', 1 FROM d WHERE shape = 5
  UNION ALL SELECT 'bad_rows_type', 1 FROM d WHERE shape = 5
  UNION ALL SELECT 'bad_row_type', 2 FROM d WHERE shape = 6
  UNION ALL SELECT 'missing_datetime', n FROM d WHERE shape = 7)
SELECT reason, CAST(sum(k) AS BIGINT) AS n_pieces, count(*) AS n_files FROM r GROUP BY reason""", "bars_daily"), ("SRC4", "SRC3"))
def raw_quarantine(spark, sf):
    """Refused pieces of damaged documents, written with place, reason and text, and counted from there."""
    path = _scratch(spark, "quarantine")
    landing.raw_rejects(_malformed(_docs(spark, sf))).write.parquet(path)
    kept = spark.read.parquet(path).where(F.col("piece").isNotNull() & F.col("file_name").isNotNull())
    return kept.groupBy("reason").agg(F.count(F.lit(1)).alias("n_pieces"), F.count_distinct("file_name").alias("n_files"))


@query("landing_status", with_ctes(f"""
SELECT CASE WHEN {_SHAPE} IN (1, 2, 3, 4) THEN 207 ELSE 200 END AS status, count(DISTINCT strftime(dt, '%Y%m') || series) AS n_docs
FROM bars_daily GROUP BY 1""", "bars_daily"), ("AG10",))
def landing_status(spark, sf):
    """Partial and full landings among damaged documents."""
    return landing.has_data(_malformed(_docs(spark, sf))).groupBy("status").agg(F.count(F.lit(1)).alias("n_docs"))


@query("landing_dated", with_ctes(
    f"SELECT {_PROCESSED} FROM bars_daily WHERE year(dt) = (SELECT max(year(dt)) FROM bars_daily)", "bars_daily"), ("SNK3", "SRC2"))
def landing_dated(spark, sf):
    """One landing a year under raw/YYYY/12/31, one file a document; the scan opens the last year's folder only."""
    bars = fixtures.bars_daily(spark, sf)
    docs = cut_lineage(landing.to_raw_payload(bars, run=F.make_date(F.year("dt"), F.lit(12), F.lit(31))))
    years = [r[0] for r in docs.select(F.substring("file_name", 5, 4)).distinct().collect()]     # one a run
    root = _scratch(spark, "dated")
    for y in years:
        landing.write_landing(docs, f"{root}/raw", f"{y}-12-31")
    day = landing.scan_raw_landing(spark, f"{root}/raw", f"{max(years)}-12-31", glob="*.txt")
    if any(f"/raw/{max(years)}/12/31/" not in f for f in day.inputFiles()):
        raise RuntimeError("the scan of one day opened others")
    return landing.processed_daily(landing.parse_raw_payload(day))


@query("raw_reject_report", "SELECT 'read_error' AS reason, count(*) AS n FROM pages", ("SRC2", "SRC4"))
def raw_reject_report(spark, sf):
    """Landing set = envelopes built from bars plus every crawled page as a foreign file."""
    pages = table(spark, sf, "pages").select(F.col("url").alias("file_name"), F.col("html").alias("value"))
    return landing.raw_reject_report(_docs(spark, sf).unionByName(pages))


_TICKERS = "1-URGENT, 3-MEDIUM,, "


@query("select_tickers", with_ctes("SELECT * FROM bars_daily WHERE series IN ('1-URGENT', '3-MEDIUM')",
                                   "bars_daily"), ("PF6", "SC5"))
def select_tickers(spark, sf):
    return landing.select_tickers(fixtures.bars_daily(spark, sf), _TICKERS)


@query("union_sources", with_ctes(
    "SELECT series, CAST(dt AS TIMESTAMP) AS dt, open, high, low, close, volume, 'orders' AS source FROM bars_daily "
    "UNION ALL SELECT series, CAST(dt AS TIMESTAMP), open, high, low, close, volume, 'events' FROM bars_hourly",
    "bars_daily", "bars_hourly"), ("ST1",))
def union_sources(spark, sf):
    d = fixtures.bars_daily(spark, sf).withColumn("dt", F.col("dt").cast("timestamp"))
    h = fixtures.bars_hourly(spark, sf).withColumn("dt", F.col("dt").cast("timestamp"))
    return sel.union_sources({"orders": d, "events": h})


_AS_OF = "2001-08-09"


@query("first_non_empty", with_ctes(f"""
WITH r AS (SELECT *, datediff('day', CAST(dt AS DATE), DATE '{_AS_OF}') AS age FROM bars_daily
           WHERE CAST(dt AS DATE) < DATE '{_AS_OF}'),
p AS (SELECT *, CASE WHEN age <= 7 THEN 0 WHEN age <= 30 THEN 1 WHEN age <= 90 THEN 2 WHEN age <= 365 THEN 3
      ELSE 4 END AS priority FROM r),
b AS (SELECT series, min(priority) AS best FROM p GROUP BY series)
SELECT p.series, dt, open, high, low, close, volume, CAST(priority AS INTEGER) AS priority
FROM p JOIN b ON p.series = b.series WHERE priority <= best""", "bars_daily"), ("ST2",))
def first_non_empty(spark, sf):
    return sel.first_non_empty(fixtures.bars_daily(spark, sf), _AS_OF)


@query("trailing_window", with_ctes(
    "SELECT b.* FROM bars_daily b JOIN (SELECT series, max(dt) AS m FROM bars_daily GROUP BY series) x "
    "ON b.series = x.series WHERE b.dt >= x.m - INTERVAL 1095 DAY", "bars_daily"), ("PF3", "JN6"))
def trailing_window(spark, sf):
    return sel.trailing_window(fixtures.bars_daily(spark, sf), years=3)


@query("lookback", with_ctes(
    "SELECT * FROM bars_daily WHERE dt >= DATE '2000-01-01' - INTERVAL 365 DAY AND dt < DATE '2000-01-01'",
    "bars_daily"), ("PF4",))
def lookback(spark, sf):
    return sel.lookback(fixtures.bars_daily(spark, sf), "2000-01-01", 365)


@query("props_json", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
  count(*) - count(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS n_missing,
  CAST(sum(coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), -1)) AS BIGINT) AS k_sum_default,
  min(coalesce(json_extract_string(props, '$.absent'), 'none')) AS absent
FROM events GROUP BY event_type""", ("SC7",))
def props_json(spark, sf):
    """Key lookup with default in a JSON scalar column."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (table(spark, sf, "events").groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k_sum"),
                 (F.count(F.lit(1)) - F.count(k)).alias("n_missing"), F.sum(F.coalesce(k, F.lit(-1))).alias("k_sum_default"),
                 F.min(F.coalesce(F.get_json_object("props", "$.absent"), F.lit("none"))).alias("absent")))


@query("date_strings", """
SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
  strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS compact,
  strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d') AS slashed, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS stamp,
  true AS roundtrip_ok, count(CASE WHEN try_strptime(o_orderpriority, '%Y-%m-%d') IS NULL THEN 1 END) AS n_bad_dates
FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderdate""", ("SC5", "SC6"))
def date_strings(spark, sf):
    """Date formats used by landing keys, parsed back (compact, slashed, ISO)."""
    o = table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    iso, compact = F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "yyyyMMdd")
    slashed = F.date_format(d, "yyyy/MM/dd")
    ok = ((F.try_to_timestamp(compact, F.lit("yyyyMMdd")).cast("date") == d)
          & (F.try_to_timestamp(slashed, F.lit("yyyy/MM/dd")).cast("date") == d)
          & (F.regexp_replace(iso, "-", "") == compact) & (F.substring(iso, 1, 10) == iso))
    # a text that is no date gives NULL, not an error
    bad = F.try_to_timestamp("o_orderpriority", F.lit("yyyy-MM-dd")).isNull()
    g = o.groupBy(d.alias("d"), F.col("o_orderdate")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(bad, 1)).alias("n_bad_dates"))
    return g.select("d", "n", "n_bad_dates", F.date_format("d", "yyyy-MM-dd").alias("iso"),
                    F.date_format("d", "yyyyMMdd").alias("compact"), F.date_format("d", "yyyy/MM/dd").alias("slashed"),
                    F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'").alias("stamp"),
                    ((F.try_to_timestamp(F.date_format("d", "yyyyMMdd"), F.lit("yyyyMMdd")).cast("date") == F.col("d"))
                     & (F.try_to_timestamp(F.date_format("d", "yyyy/MM/dd"), F.lit("yyyy/MM/dd")).cast("date")
                        == F.col("d"))).alias("roundtrip_ok"))


@query("landing_stream", QUERIES_DEDUP_SQL, ("SM1", "SM2", "SRC2", "SNK2", "AG8"))
def landing_stream(spark, sf):
    """Two landings written as files (the second revises close where volume > 1),
    each processed by an availableNow file stream with a last-wins merge; the
    table then equals the batch dedup of both landings."""
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming.landing_stream import read_processed, run_landing_stream

    base = os.path.join(ensure_checkpoint_dir(spark), f"landing-{uuid.uuid4().hex}")
    root, table, ckpt = f"{base}/raw", f"{base}/processed", f"{base}/_stream_ckpt"
    bars = fixtures.bars_daily(spark, sf)
    first = landing.to_raw_payload(bars)
    revised = landing.to_raw_payload(bars.where(F.col("volume") > 1).withColumn("close", F.col("high")),
                                     run_time="120000")
    for stamp, docs in (("20240101T000000Z", first), ("20240101T120000Z", revised)):
        docs.select("value").write.mode("overwrite").text(f"{root}/{stamp}")
        run_landing_stream(spark, root, table, ckpt)
    return read_processed(spark, table)


def _scratch(spark, tag):
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


@query("bars_csv_roundtrip", with_ctes(
    "SELECT series, CAST(dt AS TIMESTAMP) AS dt, open, high, low, close, volume FROM bars_daily", "bars_daily"),
    ("SRC1", "SNK1", "PF1"))
def bars_csv_roundtrip(spark, sf):
    """Bars written as a provider-style CSV (Date index, two-level names, an
    'Adj Close' to drop), read back with time-column precedence and name
    normalisation."""
    from ..sources.bars import read_bars_csv
    from ..sources.sinks import write_table
    path = _scratch(spark, "bars-csv")
    b = fixtures.bars_daily(spark, sf)
    wide = b.select("series", F.col("dt").cast("string").alias("Date"), F.col("open").alias("Open_GC=F"),
                    F.col("high").alias("High_GC=F"), F.col("low").alias("Low_GC=F"),
                    F.col("close").alias("Close_GC=F"), F.col("close").alias("Adj Close_GC=F"),
                    F.col("volume").alias("Volume_GC=F"))
    write_table(wide, path, fmt="csv")
    return read_bars_csv(spark, path)


@query("landing_job", QUERIES_SELECT_DATE_SQL,
       ("SRC2", "SNK2", "SL2", "PF5", "AG8"))
def landing_job(spark, sf):
    """Lifecycle A on files: envelopes landed as JSON lines, the processing job
    picks the latest date (requested date absent, not forced), keeps the last
    copy of each row and writes the day's CSV partition; read back."""
    from ..plans import landing_job as job
    base = _scratch(spark, "landing-job")
    _docs(spark, sf).select("value").write.text(f"{base}/raw/20240101T000000Z")
    job.run(spark, f"{base}/raw", f"{base}/processed", "2099-01-01", forced=False, glob="*.txt",
            one_doc_per_line=True)
    return job.read_processed_daily(spark, f"{base}/processed")
