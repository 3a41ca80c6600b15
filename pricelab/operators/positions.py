"""Positions by value: where each row stands when a group is sorted by a value.

Small groups sort in one window. A hot group must not: there the rows are range
partitioned by (keys, value, further order columns) over as many partitions as the chunk
size asks for, so that one group spans several of them whatever the values look like
(returns within a thousandth, log-normal sizes, a third of all rows equal). Rows are counted
per key and partition, the counts are prefix-summed in that small table, and
a row's position is its partition's offset plus its rank inside. Equal values either
carry a count or are told apart by the further order columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import conf_int, cut_lineage
from .layout import CHUNK_ROWS_KEY, POS

PART, COUNT = "_part", "_n"


def value_positions(df: DataFrame, keys: list[str], order: list[str], mode: str, weight: str | None = None,
                    wanted: Callable[[Column], list[Column]] | None = None) -> DataFrame:
    """``df`` with ``_pos`` (0-based, of the first of ``weight`` equal rows) and ``_n`` (rows of the group).

    ``mode``: 'plain', 'halo' or 'halo:<rows>' as ``layout.resolve_mode`` gives it. ``order`` (with
    ``keys``) must tell rows apart. ``wanted(n)`` names the positions that are needed, so that only
    partitions that hold one of them are sorted."""
    one = F.col(weight) if weight else F.lit(1)
    if mode == "plain":
        w = Window.partitionBy(*keys).orderBy(*order)
        upto = F.sum(one).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return df.select("*", (upto - one).alias(POS), F.sum(one).over(Window.partitionBy(*keys)).alias(COUNT))
    spark = df.sparkSession
    rows = int(mode.split(":")[1]) if ":" in mode else conf_int(spark, CHUNK_ROWS_KEY, 250_000)
    parts = max(1, -(-df.count() // rows))
    # written once: a range partitioning that is computed twice may cut differently
    ranged = cut_lineage(df.repartitionByRange(parts, *keys, *order).withColumn(PART, F.spark_partition_id()))
    sizes = ranged.groupBy(*keys, PART).agg(F.sum(one).alias("_c"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, PART, "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                           F.sum("_c").over(Window.partitionBy(*keys)).alias(COUNT))
    if wanted:
        holds = F.lit(False)
        for at in wanted(F.col(COUNT)):
            holds = holds | ((at >= F.col("_off")) & (at < F.col("_off") + F.col("_c")))
        offsets = offsets.where(holds)
    inside = Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(offsets.drop("_c"), [*keys, PART])
            .select(*df.columns, (F.col("_off") + F.sum(one).over(inside) - one).alias(POS), COUNT))


def quantiles(df: DataFrame, value: str, probs, keys: list[str], mode: str) -> DataFrame:
    """``(keys, q, value)``: linear-interpolation quantiles (numpy/pandas default) of the
    values that are not NULL or NaN."""
    v = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counted = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_k"))
    cuts = lambda n: [f((n - 1) * F.lit(float(q))) for q in probs for f in (F.floor, F.ceil)]
    p = value_positions(counted, keys, ["_v"], mode, "_k", cuts)
    picks = []
    for q in probs:
        h = (F.col(COUNT) - 1) * F.lit(float(q))
        for side, at in ((0, F.floor(h)), (1, F.ceil(h))):
            here = (F.col(POS) <= at) & (at < F.col(POS) + F.col("_k"))
            picks.append(F.when(here, F.struct(F.lit(float(q)).alias("q"), (h - F.floor(h)).alias("f"), F.lit(side).alias("s"))))
    tagged = p.select(*keys, "_v", F.explode(F.filter(F.array(*picks), lambda x: x.isNotNull())).alias("t"))
    g = tagged.groupBy(*keys, F.col("t.q").alias("q")).agg(
        F.first("t.f").alias("f"),
        F.max(F.when(F.col("t.s") == 0, F.col("_v"))).alias("a"),
        F.max(F.when(F.col("t.s") == 1, F.col("_v"))).alias("b"))
    return g.select(*keys, "q", (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("value"))
