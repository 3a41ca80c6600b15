"""Lifecycle A: raw landing -> processed daily table, as one lazy plan.

SRC2 scan -> SRC3/PF2 decode -> PF5 date choice -> AG8 last-wins -> SNK2 write.
The only shuffles are the dedup and the partitioned write.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources import landing


def run(spark: SparkSession, landing_root: str, out_path: str, date: str | None, forced: bool | None = None,
        scan_date: str | None = None, glob: str = "*.json", one_doc_per_line: bool = False) -> int:
    """``date`` None = today (UTC), not forced; an explicit date is validated and
    forced unless ``forced`` says otherwise. ``scan_date='process'`` reads only
    that day's ``raw/YYYY/MM/DD`` folder, as the scheduled job does."""
    date, explicit = landing.parse_process_date(date)
    forced = explicit if forced is None else forced
    if scan_date == "process":
        scan_date = date
    docs = landing.scan_raw_landing(spark, landing_root, scan_date, glob, one_doc_per_line)
    rows = landing.parse_raw_payload(docs)
    chosen = landing.select_process_date(rows, date, forced)
    best = landing.dedup_last(chosen)
    landing.write_processed_daily(best, out_path)
    return read_processed_daily(spark, out_path).count()


PROCESSED_SCHEMA = ("datetime string, ticker string, open double, high double, low double, close double, "
                    "volume long, date string")


def read_processed_daily(spark: SparkSession, path: str):
    return spark.read.schema(PROCESSED_SCHEMA).option("header", True).csv(path).select(*landing.PROCESSED_COLUMNS)
