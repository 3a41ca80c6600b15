"""SQL text helpers for the DuckDB oracle (same value rules as the Spark code)."""

from __future__ import annotations

INF = "CAST('inf' AS DOUBLE)"
NEG_INF = "CAST('-inf' AS DOUBLE)"


def pdiv(a: str, b: str) -> str:
    return (f"(CASE WHEN ({b}) IS NULL THEN NULL WHEN ({b}) <> 0 THEN ({a}) / ({b}) WHEN ({a}) > 0 THEN {INF} "
            f"WHEN ({a}) < 0 THEN {NEG_INF} END)")


class W:
    """Window clause builder: ``W('series', 'dt')``."""

    def __init__(self, part="series", order="dt"):
        self.part = part
        self.order = order

    def spec(self, frame: str = "") -> str:
        return f"(PARTITION BY {self.part} ORDER BY {self.order} {frame})".replace(" )", ")")

    def lag(self, x: str, k: int = 1) -> str:
        return f"lag({x}, {k}) OVER {self.spec()}"

    def lead(self, x: str, k: int = 1) -> str:
        return f"lead({x}, {k}) OVER {self.spec()}"

    def full(self, agg: str, x: str, k: int) -> str:
        fr = self.spec(f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW")
        return f"(CASE WHEN count({x}) OVER {fr} = {k} THEN {agg}({x}) OVER {fr} END)"


def rounded_select(inner: str, columns: list[tuple[str, int | None]], alias: str = "q") -> str:
    """``select round(c, d) as c ...`` over ``inner``; d None = as is."""
    items = [(f"round({c}, {d}) AS {c}" if d is not None else c) for c, d in columns]
    return f"SELECT {', '.join(items)} FROM ({inner}) {alias}"
