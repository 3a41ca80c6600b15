"""SM1 / SM2: incremental landing -> processed daily table with Structured Streaming.

File source on the landing folder -> envelope decode (SRC3 + PF2) ->
``foreachBatch`` merge: rows of the batch plus the stored rows of the dates it
touches, reduced with last-wins (AG8: later file, later position), written
back with dynamic partition overwrite of the touched dates. ``dropDuplicates`` keeps the first row,
so it cannot express last-wins. With ``availableNow`` the stream processes
what has landed and stops; the result equals the batch job on the same files.
Every date is kept (the batch job's date choice PF5 stays batch-only).

What has been read is kept per (root, table): the default checkpoint is named after both, so
two tables can be filled from one root.

The merged batch is checkpointed to the shared checkpoint folder before the
write, so the overwrite never reads the partitions it is replacing.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, has_files
from ..sources import landing

KEYS = ("ticker", "datetime")
PART = "date"  # table partition: a merge rewrites only the dates a batch touches


def _read_stream(spark: SparkSession, root: str, wholetext: bool, glob: str):
    r = spark.readStream.format("text")
    if wholetext:
        r = r.option("wholetext", True)
    # dated landings are folders of folders: raw/YYYY/MM/DD/*.json
    src = r.option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return src.select(F.col("_metadata.file_path").alias("file_name"), "value", F.col("_metadata.file_block_start").alias("_block"))


def merge_batch(batch: DataFrame, table_path: str) -> None:
    spark = batch.sparkSession
    docs = batch.withColumn("line_pos", F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("id")))
    rows = cut_lineage(landing.dedup_last(landing.parse_raw_payload(docs), KEYS).withColumn(PART, F.substring("datetime", 1, 10)))
    if rows.isEmpty():
        return
    merged = rows
    if has_files(spark, table_path):  # an unreadable or changed table must fail, not be overwritten
        dates = rows.select(PART).distinct()
        old = spark.read.parquet(table_path).withColumn(PART, F.col(PART).cast("string"))
        merged = rows.unionByName(old.join(dates, PART, "left_semi").select(*rows.columns))
    best = landing.dedup_last(merged.drop(PART), KEYS).withColumn(PART, F.substring("datetime", 1, 10))
    best = cut_lineage(best)
    (best.repartitionByRange(landing.write_tasks(best, PART), PART, "ticker", "datetime").sortWithinPartitions(PART, "ticker", "datetime")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(table_path))


def run_landing_stream(spark: SparkSession, root: str, table_path: str, checkpoint: str | None = None,
                       wholetext: bool = False, glob: str = "*.txt", timeout_s: int | None = None) -> None:
    """Process everything landed under ``root`` once (availableNow) into ``table_path``.

    Waits until all of it is processed; a ``timeout_s`` that runs out raises."""
    name = hashlib.sha256(f"{root.rstrip('/')}|{table_path.rstrip('/')}".encode()).hexdigest()[:32]
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "landing_stream", name)
    q = (_read_stream(spark, root, wholetext, glob).writeStream
         .foreachBatch(lambda df, _id: merge_batch(df, table_path))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"landing stream still running after {timeout_s} s")
    if q.exception():
        raise q.exception()


def read_processed(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path).select(*landing.PROCESSED_COLUMNS)
