"""Spark session helpers.

Cluster settings win: every helper reads the running session's conf first and
only fills a value in when it is unset (local tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session defaults for local runs; a cluster's spark-defaults override none of
# these because ``getOrCreate`` returns the already-configured session.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, app: str = "pricelab",
              shuffle_partitions: int | None = None, driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # UTC makes TIMESTAMP values print and compare the same everywhere.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    jit_sized(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pricelab`` importable in Python workers (pandas UDFs pickle
    references to its modules). The package is zipped once per SparkContext
    and handed to ``addPyFile``, which distributes it to every executor."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="pricelab-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if none is configured."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    # Only reached in local tests / bench: a cluster names a shared folder.
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="pricelab-ckpt-", dir=os.environ.get("PRICELAB_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def jit_sized(spark: SparkSession) -> None:
    """Wide projections over windows generate methods of more than 8000 bytes, which the JVM never
    compiles. From this limit on Spark uses projections in small methods instead. A
    limit that the session has already stays."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, "8000")


CONSTRAINTS = "spark.sql.constraintPropagation.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss).

    A checkpoint derives the constraints of its whole plan, in time exponential in
    the number of columns that share expressions (the features do); nothing uses them here."""
    ensure_checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(CONSTRAINTS)
    conf.set(CONSTRAINTS, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.set(CONSTRAINTS, before)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system finds data files below ``path``: false for a missing or
    empty folder (a first write that failed leaves one)."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(found):
        return False
    files = fs.listFiles(found, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default
