"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...] = ()


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def rounded(c: str, d: int) -> Column:
    """``F.round`` of a DOUBLE column, which goes through a decimal number, in double arithmetic
    wherever that is sure to give the same value: below 1e11 units of the last place the
    product is off by less than 1e-4 of one, so only values that close to a tie need the decimal.
    The quotient of two exact integers is the double nearest to the rounded decimal; + 0.0
    turns -0.0 into the 0.0 that a decimal has."""
    unit = 10.0 ** d
    scaled = F.col(c) * F.lit(unit)
    sure = (F.abs(scaled) < F.lit(1e11)) & (F.abs(scaled - F.rint(scaled)) < F.lit(0.499))
    return F.when(sure, F.rint(scaled) / F.lit(unit) + F.lit(0.0)).otherwise(F.round(F.col(c), d))


def round_df(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Round the named DOUBLE columns (same rule as ``sql.rounded_select``)."""
    types = dict(df.dtypes)
    return df.select(*[((rounded(c, decimals[c]) if types[c] == "double" and 0 <= decimals[c] <= 15 else F.round(F.col(c), decimals[c])).alias(c)
                        if c in decimals else F.col(c)) for c in df.columns])
