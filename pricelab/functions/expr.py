"""Column-expression helpers shared by every operator (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def inf() -> Column:
    return F.lit(float("inf"))


def neg_inf() -> Column:
    return F.lit(float("-inf"))


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pdiv(a, b) -> Column:
    """pandas-style division: x/0 -> +-inf, 0/0 -> NULL (pandas NaN), NULL stays NULL.

    ANSI Spark raises on a double division by zero, so the zero case is routed
    explicitly. The oracle writes the same CASE.
    """
    a, b = col(a), col(b)
    return (F.when(b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(a > 0, inf())
            .when(a < 0, neg_inf()))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def full(agg_fn, c, w: WindowSpec, k: int) -> Column:
    """pandas ``rolling(k).<agg>()`` with its default ``min_periods=k``.

    Value only when the trailing k-row frame holds k non-null inputs.
    """
    frame = w.rowsBetween(1 - k, 0)
    return F.when(F.count(col(c)).over(frame) == k, agg_fn(col(c)).over(frame))


def series_window(series: str, order, part_extra: list[str] | None = None) -> WindowSpec:
    keys = [series] + list(part_extra or [])
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*keys).orderBy(*orders)


def dbl(x: float) -> Column:
    """A DOUBLE literal (SQL ``0.8`` is DECIMAL in Spark and DuckDB)."""
    return F.lit(float(x)).cast("double")
