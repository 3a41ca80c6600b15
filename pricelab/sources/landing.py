"""Raw landing envelopes -> processed daily table (lifecycle A).

SNK3 ``to_raw_payload``   bars -> JSON envelope documents
SRC2 ``scan_raw_landing`` one row per landed file (whole text + path)
SRC3 ``parse_raw_payload`` envelope -> candidate rows (bad shapes skipped)
SRC4 ``raw_reject_report`` skip reasons as counts
PF2  ``standardize_row``  (inside SRC3) ticker upper-cased, Open -> open ...
PF5  ``select_process_date`` requested date, or latest when not forced
AG8  ``dedup_last``        last file / last row wins per (ticker, datetime)
AG9  ``available_dates``; AG10 ``has_data``; SNK2 ``write_processed_daily``

``data`` in an envelope is union-typed (ticker map, error dict, list ...), so it
is decoded in steps: the envelope with ``data`` kept as raw JSON text, then
``map<string,string>``, then ``array<string>``, then the row struct. Every step
is a JVM JSON expression; a malformed piece turns NULL and is tagged with a
reason instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

ENVELOPE_SCHEMA = ("struct<timestamp_utc:string,interval:string,lookback_days:int,"
                   "tickers:array<string>,data:string>")
# Decoding looks at ``data`` only: a wrong type in another field keeps the document.
DATA_SCHEMA_CORRUPT = "struct<data:string,_corrupt:string>"
ROW_SCHEMA = "struct<datetime:string,Open:double,High:double,Low:double,Close:double,Volume:double>"
METADATA_KEYS = ("error", "traceback", "tickers")
#: Place of a row: later files win, then later lines of a file, tickers and rows of a document.
ORDER = ("file_name", "line_pos", "key_pos", "row_pos")
LINE_POS = "struct<block:bigint,id:bigint>"
ROWS_PER_FILE = 1_000_000
PROCESSED_COLUMNS = ("datetime", "ticker", "open", "high", "low", "close", "volume")
REASONS = ("read_error", "error_payload", "bad_data_type", "metadata_key", "bad_rows_type",
           "bad_row_type", "missing_datetime")


def _first_char(c: Column) -> Column:
    return F.substring(F.ltrim(c), 1, 1)


def _clean(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


# ---------------------------------------------------------------------------
# SNK3: bars -> envelopes
# ---------------------------------------------------------------------------

def to_raw_payload(bars: DataFrame, series: str = "series", dt: str = "dt", interval: str = "1d",
                   lookback_days: int = 7, run: Column | None = None, shards: int | None = None,
                   run_time: str = "000000") -> DataFrame:
    """One envelope per (run, shard) with ``data = {ticker: [row, ...]}``.

    ``run`` defaults to the calendar month of the bar (dated key = month end).
    A shard holds the tickers hashing to it; ``shards=None`` gives one document
    per (run, ticker), so no document grows with the number of tickers.
    Returns ``(file_name, value)``; timestamps are strings, as ``default=str``.
    """
    run_date = run if run is not None else F.last_day(F.to_date(F.col(dt)))
    shard = F.pmod(F.xxhash64(F.col(series)), F.lit(shards)) if shards else F.col(series)
    row = F.struct(F.date_format(F.col(dt), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                   F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
                   F.col("close").alias("Close"), F.col("volume").alias("Volume"))
    per_ticker = (bars.select(run_date.alias("_run"), shard.alias("_shard"), F.col(series).alias("_ticker"),
                              F.col(dt).alias("_dt"), row.alias("_row"))
                  .groupBy("_run", "_shard", "_ticker")
                  .agg(F.array_sort(F.collect_list(F.struct("_dt", "_row"))).alias("_rows")))
    per_ticker = per_ticker.select("_run", "_shard", "_ticker",
                                   F.transform("_rows", lambda x: x["_row"]).alias("_rows"))
    docs = per_ticker.groupBy("_run", "_shard").agg(
        F.array_sort(F.collect_list(F.struct("_ticker", "_rows"))).alias("_entries"))
    stamp = F.date_format(F.col("_run"), "yyyyMMdd")
    envelope = F.struct(
        F.concat(F.date_format(F.col("_run"), "yyyy-MM-dd"),
                 F.lit(f"T{run_time[:2]}:{run_time[2:4]}:{run_time[4:6]}Z")).alias("timestamp_utc"),
        F.lit(interval).alias("interval"), F.lit(lookback_days).alias("lookback_days"),
        F.transform("_entries", lambda e: e["_ticker"]).alias("tickers"),
        F.map_from_entries("_entries").alias("data"))
    name = F.concat(F.lit("raw/"), F.date_format(F.col("_run"), "yyyy/MM/dd"), F.lit("/prices_"), stamp,
                    F.lit(f"T{run_time}Z_"), F.col("_shard").cast("string"), F.lit(".json"))
    return docs.select(name.alias("file_name"), F.to_json(envelope).alias("value"))


def write_landing(docs: DataFrame, root: str, date: str, run_time: str = "000000") -> str:
    """SNK3: the documents (file_name, value) of one run, whose key is ``raw/YYYY/MM/DD``, as one
    file each below ``root/YYYY/MM/DD``; returns the run's folder. Its name holds the
    stamp, so that later runs sort behind earlier ones."""
    key = f"/{date[:4]}/{date[5:7]}/{date[8:10]}/"
    path = f"{landing_path(root, date)}/prices_{date.replace('-', '')}T{run_time}Z"
    docs.where(F.col("file_name").contains(key)).select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


# ---------------------------------------------------------------------------
# SRC2: scan
# ---------------------------------------------------------------------------

def landing_path(root: str, date: str | None = None) -> str:
    """``raw/YYYY/MM/DD`` for one date (static path = partition pruning)."""
    if not date:
        return root.rstrip("/")
    y, m, d = date[:4], date[5:7], date[8:10]
    return f"{root.rstrip('/')}/{y}/{m}/{d}"


def scan_raw_landing(spark: SparkSession, root: str, date: str | None = None, glob: str = "*.json",
                     one_doc_per_line: bool = False) -> DataFrame:
    """One row per landed document: a whole ``.json`` file (default), or one
    line of a JSON-lines file. ``file_name`` carries the path for last-wins, ``line_pos`` the
    line's place in its file: start of the split, then the order inside it."""
    r = spark.read
    if not one_doc_per_line:
        r = r.option("wholetext", True)
    return (r.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(landing_path(root, date))
            .select(F.col("_metadata.file_path").alias("file_name"), "value", line_position()))


def line_position() -> Column:
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("line_pos")


# ---------------------------------------------------------------------------
# SRC3 / SRC4: decode
# ---------------------------------------------------------------------------

def _decode(docs: DataFrame) -> DataFrame:
    """Explode documents to ticker-row level, tagging each piece with a reason.

    One pass: ``posexplode_outer`` keeps a rejected document (or ticker key) as
    a single row, so document, key and row rejects come out of the same chain
    and the source is read once.
    Output: file_name, line_pos, key_pos, ticker_raw, row_pos, row (struct), reason, piece."""
    place = ["file_name", "line_pos"]
    if "line_pos" not in docs.columns:
        docs = docs.withColumn("line_pos", F.lit(None).cast(LINE_POS))
    # PERMISSIVE from_json keeps an unreadable file's text in the corrupt-record
    # field; NaN numbers are accepted (the landing writer emits them).
    env = docs.select(*place, "value", F.from_json("value", DATA_SCHEMA_CORRUPT,
                                                   {"columnNameOfCorruptRecord": "_corrupt"}).alias("env"))
    valid = F.col("env._corrupt").isNull() & F.col("env").isNotNull()
    data = F.col("env.data")
    dmap = F.from_json(data, "map<string,string>")
    doc_reason = (F.when(~valid, "read_error")
                  # no data at all is an empty document, ``"data": null`` is one of a wrong type
                  .when(data.isNull(), F.when(F.array_contains(F.json_object_keys("value"), "data"), "bad_data_type"))
                  .when(_first_char(data) != "{", "bad_data_type")
                  .when(F.map_contains_key(dmap, "error"), "error_payload"))
    d1 = env.select(*place, doc_reason.alias("_dr"), dmap.alias("_map"), F.when(doc_reason.isNotNull(), F.col("value")).alias("_doc"))
    keys = d1.select(*place, "_dr", "_doc", F.posexplode_outer(
        F.when(F.col("_dr").isNull(), F.map_entries("_map"))).alias("key_pos", "_kv"))
    keys = keys.select(*place, "_dr", "_doc", "key_pos", F.col("_kv.key").alias("ticker_raw"),
                       F.col("_kv.value").alias("_rows_raw"))
    key_reason = (F.when(F.col("_dr").isNotNull() | F.col("ticker_raw").isNull(), F.lit(None))
                  .when(F.col("ticker_raw").isin(*METADATA_KEYS), "metadata_key")
                  .when(F.col("_rows_raw").isNull() | (_first_char(F.col("_rows_raw")) != "["), "bad_rows_type"))
    keys = keys.select("*", key_reason.alias("_kr"))
    usable = F.col("_dr").isNull() & F.col("ticker_raw").isNotNull() & F.col("_kr").isNull()
    rows = keys.select(*place, "_dr", "_doc", "key_pos", "ticker_raw", "_kr", F.when(F.col("_kr").isNotNull(), F.col("_rows_raw")).alias("_list"), F.posexplode_outer(
        F.when(usable, F.from_json("_rows_raw", "array<string>"))).alias("row_pos", "_row_raw"))
    parsed = F.from_json(F.col("_row_raw"), ROW_SCHEMA)
    rows = rows.select("*", parsed.alias("row"))
    row_reason = (F.when(F.col("row_pos").isNull(), F.lit(None))
                  .when(F.col("_row_raw").isNull() | (_first_char(F.col("_row_raw")) != "{"), "bad_row_type")
                  .when(F.coalesce(F.col("row.datetime"), F.lit("")) == "", "missing_datetime"))
    reason = F.coalesce(F.col("_dr"), F.col("_kr"), row_reason)
    out = rows.select(*place, "key_pos", "ticker_raw", "row_pos", "row", reason.alias("reason"),
                      F.coalesce("_doc", "_list", "_row_raw", F.lit("null")).alias("piece"), F.col("row_pos").isNotNull().alias("_has_row"))
    # Keep rejects and real rows; drop the placeholder rows of empty maps/arrays.
    out = out.where(F.col("reason").isNotNull() | F.col("_has_row"))
    return out.select(*place, "key_pos", "ticker_raw", "row_pos",
                      F.when(F.col("reason").isNull(), F.col("row")).alias("row"), "reason", "piece")


def parse_raw_payload(docs: DataFrame) -> DataFrame:
    """SRC3 + PF2: valid candidate rows with their position for last-wins.

    Output: datetime, ticker, open, high, low, close, volume, file_name, line_pos, key_pos, row_pos."""
    d = _decode(docs).where(F.col("reason").isNull())
    return d.select(
        F.col("row.datetime").alias("datetime"), F.upper(F.col("ticker_raw")).alias("ticker"),
        _clean(F.col("row.Open")).alias("open"), _clean(F.col("row.High")).alias("high"),
        _clean(F.col("row.Low")).alias("low"), _clean(F.col("row.Close")).alias("close"),
        _clean(F.col("row.Volume")).cast("long").alias("volume"),
        *ORDER)


def raw_rejects(docs: DataFrame) -> DataFrame:
    """SRC4: the quarantine, one row per skipped piece: where it stands (file, line, ticker
    key, row; NULL below the level that was refused), why, and its text."""
    return (_decode(docs).where(F.col("reason").isNotNull())
            .select(*ORDER[:2], "key_pos", F.col("ticker_raw").alias("ticker"), "row_pos", "reason", "piece"))


def raw_reject_report(docs: DataFrame) -> DataFrame:
    """SRC4: count of skipped pieces per reason (documents, ticker keys or rows)."""
    return (_decode(docs).where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------------------
# PF5, AG8, AG9, AG10
# ---------------------------------------------------------------------------

def parse_process_date(date: str | None, today: str | None = None) -> tuple[str, bool]:
    """SC6 / PF5 input: an explicit date must be ``YYYY-MM-DD`` and is forced;
    none means today (UTC), not forced. A malformed date raises ValueError
    (the job answers with an error instead of guessing)."""
    import datetime as _dt
    if date is None:
        return (today or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")), False
    try:
        _dt.datetime.strptime(date, "%Y-%m-%d")
    except ValueError as exc:
        raise ValueError(f"Invalid process_date format, expected YYYY-MM-DD, got: {date}") from exc
    return date, True


def resolve_process_date(rows: DataFrame, date: str, forced: bool) -> str | None:
    """PF5: the date to process. A one-row aggregate returns a scalar to the
    driver, so the final filter is a literal that prunes partitions/pushes down."""
    d = F.substring("datetime", 1, 10)
    r = rows.agg(F.max(d).alias("latest"), F.max((d == F.lit(date)).cast("int")).alias("has")).first()
    if forced or (r["has"] or 0) == 1 or r["latest"] is None:
        return date
    return r["latest"]


def select_process_date(rows: DataFrame, date: str, forced: bool = False) -> DataFrame:
    """PF5: the rows of the date to process; the landing is decoded once."""
    rows = cut_lineage(rows)
    chosen = resolve_process_date(rows, date, forced)
    return rows.where(F.substring("datetime", 1, 10) == F.lit(chosen))


def dedup_last(rows: DataFrame, keys=("ticker", "datetime"),
               order=ORDER) -> DataFrame:
    """AG8: one row per key; the row from the last file (lexical = UTC stamp), its last line
    and last position wins. A grouped ``max_by`` combines map-side, so a key
    with very many copies is reduced before the shuffle."""
    vals = [c for c in rows.columns if c not in keys and c not in order]
    best = F.max_by(F.struct(*vals, *order), F.struct(*order))
    return rows.groupBy(*keys).agg(best.alias("_v")).select(*keys, "_v.*")


def available_dates(rows: DataFrame) -> DataFrame:
    """AG9: distinct date prefixes with row counts; ``is_latest`` marks the max."""
    d = rows.groupBy(F.substring("datetime", 1, 10).alias("date")).agg(F.count(F.lit(1)).alias("n_rows"))
    d = cut_lineage(d)                        # one row a date, and the landing decoded once
    latest = d.agg(F.max("date")).first()[0]  # a scalar, not data
    return d.select("date", "n_rows", (F.col("date") == F.lit(latest)).alias("is_latest"))


def has_data(docs: DataFrame) -> DataFrame:
    """AG10: per landed document, whether any ticker has >= 1 row; 200 or 207. Keys that
    are no tickers (the list of an error payload) do not count."""
    env = docs.select("file_name", F.from_json("value", "struct<data:string>").alias("env"))
    dmap = F.from_json(F.col("env.data"), "map<string,string>")
    dmap = F.map_filter(dmap, lambda k, v: ~k.isin(*METADATA_KEYS))
    sizes = F.transform(F.map_values(dmap), lambda v: F.coalesce(F.size(F.from_json(v, "array<string>")), F.lit(0)))
    any_rows = F.coalesce(F.exists(sizes, lambda n: n > 0), F.lit(False))
    return env.select("file_name", any_rows.alias("has_data"),
                      F.when(any_rows, 200).otherwise(207).alias("status"))


def processed_daily(rows: DataFrame) -> DataFrame:
    """Fixed column order of the processed table (SL2 order is applied at write)."""
    return rows.select(*PROCESSED_COLUMNS)


def write_tasks(df: DataFrame, part: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Tasks for a partitioned write: files of ``rows_per_file`` rows, and many small
    partitions shared among the usual number of tasks."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(part).alias("k")).first()
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-r["n"] // rows_per_file), min(r["k"], usual))


def write_processed_daily(rows: DataFrame, path: str, fmt: str = "csv", rows_per_file: int = ROWS_PER_FILE) -> None:
    """SNK2: one folder per date, sorted by (ticker, datetime) over its files in name order.

    Rows are split by ranges of (date, ticker, datetime), so a large day is written by many tasks
    in files of about ``rows_per_file`` rows and a task's small days share it. A rerun
    replaces the dates it writes and no others: files are staged and moved in when
    all are complete (dynamic partition overwrite)."""
    out = cut_lineage(processed_daily(rows).withColumn("date", F.substring("datetime", 1, 10)))
    (out.repartitionByRange(write_tasks(out, "date", rows_per_file), "date", "ticker", "datetime").sortWithinPartitions("date", "ticker", "datetime")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file)
        .option("header", True).partitionBy("date").format(fmt).save(path))


def select_tickers(df: DataFrame, tickers_csv: str, col: str = "series") -> DataFrame:
    """PF6: comma list -> trimmed, non-blank names; a literal IN list reaches the scan."""
    names = [t.strip() for t in tickers_csv.split(",") if t.strip()]
    return df.where(F.col(col).isin(*names))
