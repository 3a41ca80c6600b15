"""Feature queries (WN1-WN14, SC1-SC3, PF7, PF12-PF14) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_NAMES, calendar_columns
from ..operators import features as fe
from ..operators.ema import add_ema, ema_lookback
from ..operators.layout import series_layout
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from .registry import query, round_df
from .sql import W, pdiv, rounded_select

# ---------------------------------------------------------------------------
# Column classes and comparison rounding (applied on both sides).
# Price-level values (~1e5) keep 4 decimals, ratios/returns 9, RSI 7.
# ---------------------------------------------------------------------------

PRICE_LEVEL_PREFIXES = ("open", "high", "low", "close", "lag_", "roll_mean", "roll_std", "roll_min",
                        "roll_max", "ema_", "macd", "bb_upper", "bb_middle", "bb_lower", "price_change",
                        "oc_change", "hl_range", "true_range", "atr_", "y_day", "y_week")


def decimals_for(name: str) -> int | None:
    if name in ("series", "dt", "seq", "volume") or name.startswith("volume_lag") or name in CALENDAR_NAMES:
        return None
    if name in ("price_change_pct", "oc_change_pct", "hl_range_pct"):
        return 9
    if name.startswith("rsi_"):
        return 7
    if name.startswith(PRICE_LEVEL_PREFIXES) and not name.startswith("roll_return"):
        return 4
    return 9


def _rounded(df):
    return round_df(df, {c: d for c in df.columns if (d := decimals_for(c)) is not None})


def _rounded_sql(inner: str, cols: list[str]) -> str:
    return rounded_select(inner, [(f'"{c}"', decimals_for(c)) for c in cols])


# ---------------------------------------------------------------------------
# SQL mirrors of the feature families
# ---------------------------------------------------------------------------

def price_sql(w: W, hl=True, op=True) -> list[tuple[str, str]]:
    r = f"(ln(close) - {w.lag('ln(close)')})"
    cols = [("return", r), ("return_abs", f"abs{r}"), ("price_change", f"(close - {w.lag('close')})"),
            ("price_change_pct", f"({pdiv('close', w.lag('close'))} - 1)")]
    if hl:
        cols += [("hl_ratio", pdiv("high", "low")), ("close_to_high", pdiv("close", "high")),
                 ("close_to_low", pdiv("close", "low"))]
    if op:
        cols += [("oc_change", "(close - open)"), ("oc_change_pct", pdiv("close - open", "open"))]
    return cols


def lag_sql(w: W, volume=True) -> list[tuple[str, str]]:
    cols = [(f"lag_{k}", w.lag("close", k)) for k in fe.LAGS]
    cols += [(f"return_lag_{k}", f"(ln(close) - {w.lag('ln(close)', k)})") for k in fe.RETURN_LAGS]
    if volume:
        cols += [(f"volume_lag_{k}", w.lag("volume", k)) for k in fe.VOLUME_LAGS]
    return cols


def helper_sql(w: W, hl=True) -> list[tuple[str, str]]:
    delta = f"coalesce(close - {w.lag('close')}, 0.0)"
    cols = [("_ret", f"(ln(close) - {w.lag('ln(close)')})"),
            ("_gain", f"greatest({delta}, 0.0)"), ("_loss", f"greatest(-({delta}), 0.0)")]
    if hl:
        prev = w.lag("close")
        # DuckDB greatest() also skips NULL arguments.
        cols += [("_tr", f"greatest(high - low, abs(high - {prev}), abs(low - {prev}))"),
                 ("_hl", "(high - low)")]
    return cols


def rolling_sql(w: W) -> list[tuple[str, str]]:
    cols = []
    for k in fe.ROLL_WINDOWS:
        cols += [(f"roll_mean_{k}", w.full("avg", "close", k)), (f"roll_std_{k}", w.full("stddev_samp", "close", k)),
                 (f"roll_min_{k}", w.full("min", "close", k)), (f"roll_max_{k}", w.full("max", "close", k))]
    for k in fe.ROLL_RETURN_WINDOWS:
        cols += [(f"roll_return_mean_{k}", w.full("avg", "_ret", k)),
                 (f"roll_return_std_{k}", w.full("stddev_samp", "_ret", k))]
    for k in fe.POSITION_WINDOWS:
        lo, hi = w.full("min", "close", k), w.full("max", "close", k)
        cols.append((f"price_position_{k}", pdiv(f"close - {lo}", f"{hi} - {lo}")))
    return cols


def volatility_sql(w: W, hl=True) -> list[tuple[str, str]]:
    cols = [(f"volatility_{k}", w.full("stddev_samp", "_ret", k)) for k in fe.VOLATILITY_WINDOWS]
    if hl:
        cols += [("hl_range", "_hl"), ("hl_range_pct", pdiv("_hl", "close"))]
        cols += [(f"hl_range_avg_{k}", w.full("avg", "_hl", k)) for k in fe.HL_AVG_WINDOWS]
        cols += [("true_range", "_tr")] + [(f"atr_{k}", w.full("avg", "_tr", k)) for k in fe.ATR_WINDOWS]
    return cols


def rsi_sql(w: W, k: int) -> str:
    g, l_ = w.full("avg", "_gain", k), w.full("avg", "_loss", k)
    return f"(100.0 - 100.0 / (1.0 + {pdiv(g, l_)}))"


def bollinger_sql(w: W, k=fe.BB_WINDOW, n=fe.BB_STD) -> list[tuple[str, str]]:
    m, s = w.full("avg", "close", k), w.full("stddev_samp", "close", k)
    up, lo = f"({m} + {s} * {n})", f"({m} - {s} * {n})"
    return [("bb_upper", up), ("bb_middle", m), ("bb_lower", lo), ("bb_width", pdiv(f"{up} - {lo}", m)),
            ("bb_position", pdiv(f"close - {lo}", f"{up} - {lo}"))]


def calendar_sql(dt="dt") -> list[tuple[str, str]]:
    d = f"CAST({dt} AS DATE)"
    return [("day_of_week", f"CAST(isodow({d}) - 1 AS INTEGER)"), ("month", f"CAST(month({d}) AS INTEGER)"),
            ("quarter", f"CAST(quarter({d}) AS INTEGER)"), ("day_of_month", f"CAST(day({d}) AS INTEGER)"),
            ("is_weekend", f"CAST(isodow({d}) >= 6 AS INTEGER)"),
            ("is_month_start", f"CAST(day({d}) = 1 AS INTEGER)"),
            ("is_month_end", f"CAST({d} = last_day({d}) AS INTEGER)")]


def ema_sql_cte(src: str, order: str = "dt", spans=fe.EMA_SPANS, macd=fe.MACD) -> str:
    """Recursive CTEs ``_b`` (rows numbered per series) and ``_e`` (ema_<span>,
    MACD signal per (series, rn)), with pandas' ``adjust=False`` update:
    ``e = ((1-a)*e + a*x) / ((1-a) + a)``, unchanged when ``e = x``."""
    fast, slow, sig = macd

    def a(s):
        return f"(CAST(2 AS DOUBLE) / CAST({s} + 1 AS DOUBLE))"

    def upd(prev, x, s):
        return (f"(CASE WHEN {prev} = {x} THEN {prev} ELSE ((1 - {a(s)}) * {prev} + {a(s)} * {x}) "
                f"/ ((1 - {a(s)}) + {a(s)}) END)")

    need = sorted(set(spans) | {fast, slow})
    sel0 = ", ".join(f"close AS e{s}" for s in need)
    step = ", ".join(upd(f"e.e{s}", "b.close", s) for s in need)
    line_new = f"({upd(f'e.e{fast}', 'b.close', fast)} - {upd(f'e.e{slow}', 'b.close', slow)})"
    cols = ", ".join(f"e{s}" for s in need)
    return f"""_b AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY {order}) - 1 AS rn FROM {src}),
_e(series, rn, {cols}, sig) AS (
  SELECT series, rn, {sel0}, CAST(0 AS DOUBLE) FROM _b WHERE rn = 0
  UNION ALL
  SELECT b.series, b.rn, {step}, {upd('e.sig', line_new, sig)}
  FROM _e e JOIN _b b ON b.series = e.series AND b.rn = e.rn + 1
)"""


def features_sql(src: str, order: str = "dt", hl=True, op=True, volume=True, dropna=True,
                 fixture: str = "bars_daily", bar_cols=("open", "high", "low", "close", "volume"),
                 rounded: bool = True) -> str:
    w = W("series", order)
    s1 = price_sql(w, hl, op) + lag_sql(w, volume) + helper_sql(w, hl)
    s1_sel = ", ".join(f'{e} AS "{n}"' for n, e in s1)
    emas = ", ".join(f"e.e{s} AS ema_{s}" for s in fe.EMA_SPANS)
    fast, slow, _ = fe.MACD
    macd = (f"e.e{fast} - e.e{slow} AS macd, e.sig AS macd_signal, "
            f"(e.e{fast} - e.e{slow}) - e.sig AS macd_histogram")
    keys = ["series", *(order.split(", "))]
    base = keys + [c for c in bar_cols if c not in keys]
    stage1 = (f"_be AS (SELECT b.*, {emas}, {macd} FROM _b b JOIN _e e "
              f"ON b.series = e.series AND b.rn = e.rn),\n_s1 AS (SELECT *, {s1_sel} FROM _be)")
    price_names = [n for n, _ in price_sql(w, hl, op)] + [n for n, _ in lag_sql(w, volume)]
    rolling = rolling_sql(w)
    vol = volatility_sql(w, hl)
    tech = [("rsi_14", rsi_sql(w, 14)), ("rsi_7", rsi_sql(w, 7))]
    tech += [("macd", "macd"), ("macd_signal", "macd_signal"), ("macd_histogram", "macd_histogram")]
    tech += bollinger_sql(w)
    cal = calendar_sql(order.split(", ")[0])
    tgt = [(n, w.lead("close", k)) for n, k in fe.TARGETS.items()]
    out_cols = (base + price_names + [n for n, _ in rolling] + [f"ema_{s}" for s in fe.EMA_SPANS]
                + [n for n, _ in vol] + [n for n, _ in tech] + [n for n, _ in cal] + [n for n, _ in tgt])
    exprs = ([f'"{c}"' for c in base + price_names] + [f'{e} AS "{n}"' for n, e in rolling]
             + [f"ema_{s}" for s in fe.EMA_SPANS] + [f'{e} AS "{n}"' for n, e in vol + tech + cal + tgt])
    body = (f"WITH RECURSIVE {ema_sql_cte(src, order)},\n{stage1}\n"
            f"SELECT {', '.join(exprs)} FROM _s1")
    if dropna:
        cond = " AND ".join(f'"{c}" IS NOT NULL' for c in out_cols)
        body = f"SELECT * FROM ({body}) _f WHERE {cond}"
    if not rounded:
        return with_ctes(body, fixture), out_cols
    return with_ctes(_rounded_sql(body, out_cols), fixture), out_cols


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def _bars(spark, sf):
    return fixtures.bars_daily(spark, sf)


def _family(spark, sf, make, with_helpers=False, bars=None):
    """One family over daily bars: ``make(b, W2)`` builds stage-2 columns."""
    b = bars if bars is not None else _bars(spark, sf)
    lay = series_layout(b, lookback=fe.MAX_LOOKBACK, lookahead=5)
    out = fe.two_stage(lay, b, lambda W1: [], lambda W2, f1: make(b, W2), keep=["series", "dt"])
    return _rounded(lay.finish(out))


def _family1(spark, sf, make):
    """A lag-stage family: ``make(b, W1)``."""
    b = _bars(spark, sf)
    lay = series_layout(b, lookback=fe.MAX_LOOKBACK, lookahead=5)
    out = fe.two_stage(lay, b, lambda W1: make(b, W1), lambda W2, f1: [], keep=["series", "dt"])
    return _rounded(lay.finish(out))


def _family_sql(cols: list[tuple[str, str]], helpers=False, fixture="bars_daily") -> str:
    w = W()
    src = fixture
    if helpers:
        h = ", ".join(f"{e} AS {n}" for n, e in helper_sql(w))
        src = f"(SELECT *, {h} FROM {fixture}) _h"
    inner = f"SELECT series, dt, {', '.join(f'{e} AS {chr(34)}{n}{chr(34)}' for n, e in cols)} FROM {src}"
    return with_ctes(_rounded_sql(inner, ["series", "dt"] + [n for n, _ in cols]), fixture)


def _register_family(name, spark_cols, sql_cols, helpers=False, ids=(), stage=2):
    fn = _family if stage == 2 else _family1
    query(name, _family_sql(sql_cols, helpers), ids)(lambda spark, sf: fn(spark, sf, spark_cols))


_w = W()
_register_family("price_changes", lambda b, W1: fe.price_columns(b, W1), price_sql(_w), ids=("WN3", "SC2", "SC3", "SC4"),
                 stage=1)
_register_family("lags", lambda b, W1: fe.lag_columns(b, W1), lag_sql(_w), ids=("WN1", "WN2"), stage=1)
_register_family("rolling_stats", lambda b, W2: fe.rolling_columns(b, W2, with_ema=False)[:32],
                 rolling_sql(_w)[:32], ids=("WN4",))
_register_family("rolling_return_stats",
                 lambda b, W2: fe.rolling_columns(b, W2, with_ema=False)[32:38] + fe.volatility_columns(b, W2)[:4],
                 rolling_sql(_w)[32:38] + volatility_sql(_w)[:4], helpers=True, ids=("WN5", "WN6"))
_register_family("price_position", lambda b, W2: fe.rolling_columns(b, W2, with_ema=False)[38:],
                 rolling_sql(_w)[38:], ids=("WN7",))
_register_family("true_range_atr", lambda b, W2: fe.volatility_columns(b, W2)[4:],
                 volatility_sql(_w)[4:], helpers=True, ids=("WN8", "WN9", "SC2"))
_register_family("rsi", lambda b, W2: [fe.rsi_column(W2, 14), fe.rsi_column(W2, 7)],
                 [("rsi_14", rsi_sql(_w, 14)), ("rsi_7", rsi_sql(_w, 7))], helpers=True, ids=("WN10",))
_register_family("bollinger", lambda b, W2: fe.bollinger_columns(W2), bollinger_sql(_w), ids=("WN13",))
_register_family("targets", lambda b, W2: fe.target_columns(W2),
                 [(n, _w.lead("close", k)) for n, k in fe.TARGETS.items()], ids=("WN14",))
_register_family("calendar", lambda b, W2: calendar_columns("dt"), calendar_sql("dt"), ids=("SC1",))


def _ema_query(spark, sf):
    b = _bars(spark, sf)
    lay = series_layout(b, lookback=ema_lookback(fe.EMA_SPANS, fe.MACD), lookahead=0)
    out = add_ema(lay, price="close", spans=fe.EMA_SPANS, macd=fe.MACD)
    cols = [f"ema_{s}" for s in fe.EMA_SPANS] + ["macd", "macd_signal", "macd_histogram"]
    return _rounded(lay.finish(out.select("series", "dt", *cols)))


def _ema_sql() -> str:
    fast, slow, _ = fe.MACD
    cols = ", ".join(f"e{s} AS ema_{s}" for s in fe.EMA_SPANS)
    inner = (f"WITH RECURSIVE {ema_sql_cte('bars_daily')}\n"
             f"SELECT b.series, b.dt, {cols}, e{fast} - e{slow} AS macd, sig AS macd_signal, "
             f"(e{fast} - e{slow}) - sig AS macd_histogram FROM _e e JOIN _b b ON b.series = e.series AND b.rn = e.rn")
    names = ["series", "dt"] + [f"ema_{s}" for s in fe.EMA_SPANS] + ["macd", "macd_signal", "macd_histogram"]
    return with_ctes(_rounded_sql(inner, names), "bars_daily")


query("ema_macd", _ema_sql(), ("WN11", "WN12"))(_ema_query)

_FEATURES_SQL, FEATURE_TABLE_COLUMNS = features_sql("bars_daily")


@query("features", _FEATURES_SQL, ("WN1-WN14", "SC1-SC4", "PF7", "PD1-PD4"))
def features(spark, sf):
    """Flagship: the full 96-feature table on daily bars, warm-up rows dropped."""
    return _rounded(fe.create_features(_bars(spark, sf)))


_HOURLY_SQL, _ = features_sql("bars_hourly", fixture="bars_hourly")


@query("features_hourly", _HOURLY_SQL, ("SRC7", "WN1-WN14"))
def features_hourly(spark, sf):
    return _rounded(fe.create_features(fixtures.bars_hourly(spark, sf)))


_TICKS_SQL, _ = features_sql("ticks", order="dt, seq", hl=False, op=False, volume=False,
                             fixture="ticks", bar_cols=("seq", "close"))


@query("features_ticks", _TICKS_SQL, ("WN1-WN14",))
def features_ticks(spark, sf):
    """Long single-price series (~30k rows/series at sf0.1): optional OHLV features absent."""
    return _rounded(fe.create_features(fixtures.ticks(spark, sf), order=["dt", "seq"]))


def _optimized_sql() -> str:
    keep = ["series", "dt", *fe.OPTIMIZED_FEATURES, *fe.TARGETS]
    return f"SELECT {', '.join(chr(34) + c + chr(34) for c in keep)} FROM ({_FEATURES_SQL}) _all"


@query("optimized_features", _optimized_sql(), ("PF14",))
def optimized_features(spark, sf):
    return _rounded(fe.optimized_features(fe.complete_rows(fe.create_features(_bars(spark, sf), drop_incomplete=False))))


def _catalog_sql() -> str:
    names = [c for c in FEATURE_TABLE_COLUMNS if c not in (*fe.BASE_COLUMNS, *fe.TARGETS, "series", "dt")]
    rows = []
    for category, parts in fe.CATEGORIES:
        own = [n for n in names if any(p in n for p in parts)]
        rows.append(f"SELECT '{category}' AS category, CAST({len(own)} AS BIGINT) AS n_features, {' + '.join(f'count({chr(34)}{n}{chr(34)})' for n in own)} AS n_values, "
                    f"{own[:5]!r} AS examples FROM f")
    return f"WITH f AS (SELECT * FROM ({_FEATURES_SQL}) _all) " + " UNION ALL ".join(rows)


@query("feature_catalog", _catalog_sql(), ("PF12", "PF13"))
def feature_catalog(spark, sf):
    """Features per category with their non-null counts over the whole table."""
    f = fe.create_features(_bars(spark, sf))
    return fe.feature_catalog(f)
