"""Statistics queries (AG1-AG3, AG11, SC8, TS1-TS5, TS7) on daily bars and
their simple returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats_math as sm
from ..operators import evaluate as ev
from ..operators import stats as st
from ..operators.layout import resolve_mode
from ..sources import fixtures
from ..sources.fixtures import with_ctes
from .registry import query, round_df
from .sql import pdiv

NLAGS, LB_LAGS, BINS = 30, 10, 80
_RET = ("_r AS (SELECT series, dt, close, " + pdiv("close", "lag(close) OVER (PARTITION BY series ORDER BY dt)")
        + " - 1 AS returns FROM bars_daily)")


def _returns(spark, sf):
    b = fixtures.bars_daily(spark, sf)
    return st.simple_returns(b, mode=resolve_mode(b))


def _sql(body: str) -> str:
    return with_ctes(f"WITH {_RET}\n{body}", "bars_daily")


# AG1 ----------------------------------------------------------------------

def _describe_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT series, '{col}' AS \"column\", count({x}) AS count, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, "
            f"round(quantile_cont({x}, 0.25), 4) AS p25, round(quantile_cont({x}, 0.5), 4) AS p50, "
            f"round(quantile_cont({x}, 0.75), 4) AS p75, round(max({x}), 4) AS max FROM bars_daily GROUP BY series")


@query("describe_bars", with_ctes(_describe_sql("close") + " UNION ALL " + _describe_sql("volume"), "bars_daily"),
       ("AG1",))
def describe_bars(spark, sf):
    return st.describe(fixtures.bars_daily(spark, sf), ["close", "volume"], digits=4)


@query("coverage", with_ctes("""
WITH s AS (SELECT *, CASE WHEN rn < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS rn, count(*) OVER (PARTITION BY series) AS n
        FROM bars_daily) a)
SELECT series, split, count(*) AS rows, min(dt) AS first_dt, max(dt) AS last_dt,
  CAST(sum(CAST(open IS NULL AS BIGINT) + CAST(high IS NULL AS BIGINT) + CAST(low IS NULL AS BIGINT)
   + CAST(close IS NULL AS BIGINT) + CAST(volume IS NULL AS BIGINT)) AS BIGINT) AS null_cells,
  round(avg(close), 4) AS mean_price, min(close) AS min_price, max(close) AS max_price
FROM s GROUP BY series, split""", "bars_daily"), ("AG2",))
def coverage(spark, sf):
    b = ev.time_split(fixtures.bars_daily(spark, sf), 0.8)
    return round_df(st.coverage(b, ["open", "high", "low", "close", "volume"], by=["split"]), {"mean_price": 4})


_RS = {"mean_pct": 9, "std_pct": 9, "annual_vol_pct": 9, "skew": 6, "kurtosis": 6}


@query("return_stats", _sql("""
, m AS (SELECT series, avg(returns) AS mu FROM _r WHERE returns IS NOT NULL GROUP BY series),
mo AS (SELECT _r.series, CAST(count(*) AS DOUBLE) AS n, avg(returns) AS mean, stddev_samp(returns) AS sd,
  avg((returns - mu) * (returns - mu)) AS m2, avg((returns - mu) * (returns - mu) * (returns - mu)) AS m3,
  avg((returns - mu) * (returns - mu) * (returns - mu) * (returns - mu)) AS m4
  FROM _r JOIN m ON _r.series = m.series WHERE returns IS NOT NULL GROUP BY _r.series),
g AS (SELECT *, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM mo)
SELECT series, CAST(n AS BIGINT) AS n, round(mean * 100, 9) AS mean_pct, round(sd * 100, 9) AS std_pct,
  round(sd * sqrt(252) * 100, 9) AS annual_vol_pct,
  round(g1 * sqrt(n * (n - 1)) / (n - 2), 6) AS skew,
  round(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)), 6) AS kurtosis FROM g""").replace("\n, m AS", ", m AS"),
    ("AG3",))
def return_stats(spark, sf):
    return round_df(st.return_stats(_returns(spark, sf)), _RS)


# AG11 / SC8 ---------------------------------------------------------------

@query("returns_histogram", _sql(f"""
, st AS (SELECT series, CASE WHEN max(returns) = min(returns) THEN min(returns) - 0.5 ELSE min(returns) END AS lo,
    CASE WHEN max(returns) = min(returns) THEN max(returns) + 0.5 ELSE max(returns) END AS hi, count(returns) AS n
  FROM _r WHERE returns IS NOT NULL GROUP BY series),
w AS (SELECT *, (hi - lo) / {BINS} AS width FROM st),
c AS (SELECT _r.series, CAST(least(floor((returns - lo) / width), {BINS - 1}) AS INTEGER) AS bin, count(*) AS cnt
  FROM _r JOIN w ON _r.series = w.series WHERE returns IS NOT NULL GROUP BY 1, 2),
g AS (SELECT series, lo, width, n, CAST(b.range AS INTEGER) AS bin FROM w, range({BINS}) b)
SELECT g.series, g.bin, round(lo + g.bin * width, 9) AS bin_lo, round(lo + (g.bin + 1) * width, 9) AS bin_hi,
  CAST(coalesce(cnt, 0) AS BIGINT) AS count, round(coalesce(cnt, 0) / (n * width), 9) AS density
FROM g LEFT JOIN c ON g.series = c.series AND g.bin = c.bin""").replace("\n, st AS", ", st AS"), ("AG11",))
def returns_histogram(spark, sf):
    h = st.histogram(_returns(spark, sf), "returns", BINS)
    return round_df(h, {"bin_lo": 9, "bin_hi": 9, "density": 9})


@query("normal_pdf", _sql("""
, s AS (SELECT series, avg(returns) AS mu, stddev_samp(returns) AS sigma, min(returns) AS lo, max(returns) AS hi
  FROM _r GROUP BY series),
g AS (SELECT series, mu, sigma, CAST(i.range AS INTEGER) AS i, lo + i.range * (hi - lo) / 99 AS x FROM s, range(100) i)
SELECT series, i, round(x, 9) AS x, round(exp(-((x - mu) / sigma) * ((x - mu) / sigma) / 2) / (sigma * sqrt(2 * pi())), 6) AS pdf
FROM g""").replace("\n, s AS", ", s AS"), ("SC8",))
def normal_pdf(spark, sf):
    return round_df(st.normal_pdf_grid(_returns(spark, sf), "returns", 100), {"x": 9, "pdf": 6})


# TS1 / TS2 ----------------------------------------------------------------

def _acf_sql() -> str:
    lags = ", ".join(f"d * lag(d, {k}) OVER (PARTITION BY series ORDER BY dt) AS p{k}" for k in range(NLAGS + 1))
    sums = ", ".join(f"sum(p{k}) AS s{k}" for k in range(NLAGS + 1))
    rows = " UNION ALL ".join(f"SELECT series, n, {k} AS lag, s{k} / s0 AS acf FROM sums" for k in range(NLAGS + 1))
    z = sm.z_two_sided(0.05)
    return f"""
, m AS (SELECT series, avg(returns) AS mu, count(returns) AS n FROM _r GROUP BY series),
c AS (SELECT _r.series, dt, n, returns - mu AS d FROM _r JOIN m ON _r.series = m.series WHERE returns IS NOT NULL),
p AS (SELECT series, n, {lags} FROM c),
sums AS (SELECT series, first(n) AS n, {sums} FROM p GROUP BY series),
l AS ({rows}),
v AS (SELECT *, CASE WHEN lag = 0 THEN 0.0 WHEN lag = 1 THEN 1.0 / n ELSE (1 + 2 * coalesce(sum(CASE WHEN lag >= 1 THEN acf * acf END)
  OVER (PARTITION BY series ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / n END AS var FROM l)""", z


def _acf_body():
    body, z = _acf_sql()
    return body, (f"SELECT series, CAST(lag AS INTEGER) AS lag, acf, {z!r} * sqrt(var) AS band, "
                  f"(lag > 0 AND abs(acf) > {z!r} * sqrt(var)) AS significant, n FROM v")


def _acf_query_sql():
    body, sel = _acf_body()
    return _sql(f"{body}\nSELECT series, lag, round(acf, 9) AS acf, round(band, 9) AS band, significant, n FROM ({sel}) q"
                ).replace("\n\n, m AS", ", m AS").replace("\n, m AS", ", m AS")


@query("acf", _acf_query_sql(), ("TS1",))
def acf(spark, sf):
    return round_df(st.acf(_returns(spark, sf), "returns", NLAGS), {"acf": 9, "band": 9})


def _lb_sql_body():
    body, sel = _acf_body()
    stat = ("n * (n + 2) * sum(acf * acf / (n - lag)) OVER (PARTITION BY series ORDER BY lag "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    p = sm.chi2_sf_var(sm.S("lb_stat"), "lag", LB_LAGS, sm.SqlOps)
    lb = (f"SELECT series, lag, lb_stat, {p} AS lb_pvalue, {p} < 0.05 AS significant FROM "
          f"(SELECT series, lag, {stat} AS lb_stat FROM ({sel}) a WHERE lag BETWEEN 1 AND {LB_LAGS}) b")
    return body, lb


@query("ljung_box", _sql("{}\nSELECT series, lag, round(lb_stat, 6) AS lb_stat, round(lb_pvalue, 9) AS lb_pvalue, "
                         "significant FROM ({}) q".format(*_lb_sql_body()).replace("\n\n, m AS", ", m AS")
                         .replace("\n, m AS", ", m AS")), ("TS2",))
def ljung_box(spark, sf):
    a = st.acf(_returns(spark, sf), "returns", NLAGS)
    return round_df(st.ljung_box(a, LB_LAGS), {"lb_stat": 6, "lb_pvalue": 9})


# TS3 / TS4 / TS7 ----------------------------------------------------------

def _normality_sql_body():
    n, g1, g2 = sm.S("CAST(n AS DOUBLE)"), sm.S("g1"), sm.S("g2")
    b2 = g2 + 3
    z1 = sm.skewtest_z(n, g1, sm.SqlOps)
    z2 = sm.kurtosistest_z(n, b2, sm.SqlOps)
    k2 = f"(({z1}) * ({z1}) + ({z2}) * ({z2}))"
    jb = f"(CAST(n AS DOUBLE) / 6 * (g1 * g1 + g2 * g2 / 4))"
    k2p = sm.chi2_sf(sm.S(k2), 2, sm.SqlOps)
    jbp = sm.chi2_sf(sm.S(jb), 2, sm.SqlOps)
    body = """
, m AS (SELECT series, avg(returns) AS mu FROM _r WHERE returns IS NOT NULL GROUP BY series),
mo AS (SELECT _r.series, count(*) AS n, avg((returns - mu) * (returns - mu)) AS m2,
  avg((returns - mu) * (returns - mu) * (returns - mu)) AS m3,
  avg((returns - mu) * (returns - mu) * (returns - mu) * (returns - mu)) AS m4
  FROM _r JOIN m ON _r.series = m.series WHERE returns IS NOT NULL GROUP BY _r.series),
g AS (SELECT series, n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM mo)"""
    sel = (f"SELECT series, n, {k2} AS k2_stat, {k2p} AS k2_pvalue, {k2p} > 0.05 AS k2_normal, "
           f"{jb} AS jb_stat, {jbp} AS jb_pvalue, {jbp} > 0.05 AS jb_normal FROM g")
    return body, sel


_NT = {"k2_stat": 6, "k2_pvalue": 9, "jb_stat": 6, "jb_pvalue": 9}


@query("normality_tests", _sql("{}\nSELECT series, n, round(k2_stat, 6) AS k2_stat, round(k2_pvalue, 9) AS k2_pvalue, "
                               "k2_normal, round(jb_stat, 6) AS jb_stat, round(jb_pvalue, 9) AS jb_pvalue, jb_normal "
                               "FROM ({}) q".format(*_normality_sql_body()).replace("\n\n, m AS", ", m AS")),
       ("TS3", "TS4"))
def normality_tests(spark, sf):
    return round_df(st.normality_tests(_returns(spark, sf), "returns"), _NT)


def _verdict_sql():
    acf_body, _ = _acf_body()
    _, lb = _lb_sql_body()
    n_body, n_sel = _normality_sql_body()
    n_body = n_body.replace("m AS (", "nm AS (").replace("JOIN m ON _r.series = m.series", "JOIN nm ON _r.series = nm.series")
    return _sql(f"""{acf_body}{n_body},
lb AS ({lb}), nt AS ({n_sel}),
a AS (SELECT series, max(CAST(significant AS INTEGER)) AS auto FROM lb GROUP BY series)
SELECT a.series, a.auto = 1 AS has_autocorrelation, k2_normal, jb_normal,
  CASE WHEN a.auto <> 1 AND k2_normal AND jb_normal THEN 'EXCELLENT' WHEN a.auto <> 1 THEN 'GOOD' ELSE 'CONCERNS' END AS verdict
FROM a JOIN nt ON a.series = nt.series""".replace("\n, m AS", ", m AS", 1).lstrip("\n"))


@query("residual_verdict", _verdict_sql(), ("TS7", "TS2", "TS3", "TS4"))
def residual_verdict(spark, sf):
    r = _returns(spark, sf)
    lb = st.ljung_box(st.acf(r, "returns", NLAGS), LB_LAGS)
    return st.residual_verdict(lb, st.normality_tests(r, "returns"))


# TS5 ----------------------------------------------------------------------

def _qq_sql() -> str:
    m = sm.S("(CASE WHEN i = n THEN pow(CAST(0.5 AS DOUBLE), 1 / CAST(n AS DOUBLE)) WHEN i = 1 THEN 1 - pow(CAST(0.5 AS DOUBLE), 1 / CAST(n AS DOUBLE)) "
             "ELSE (i - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END)")
    return (f", o AS (SELECT series, returns AS sample, row_number() OVER (PARTITION BY series ORDER BY returns, dt) AS i, "
            f"count(*) OVER (PARTITION BY series) AS n FROM _r WHERE returns IS NOT NULL),\n"
            f"pm AS (SELECT *, {m} AS p FROM o),\npr AS (SELECT *, {sm.ppf_tail_root(sm.S('p'), sm.SqlOps)} AS r FROM pm),\n"
            f"qq AS (SELECT series, i, sample, {sm.norm_ppf(sm.S('p'), sm.S('r'), sm.SqlOps)} AS theoretical FROM pr)")


@query("qq_points", _sql(_qq_sql() + "\nSELECT series, i, round(sample, 9) AS sample, round(theoretical, 9) AS theoretical FROM qq"
                         ).replace("\n, o AS", ", o AS"), ("TS5",))
def qq_points(spark, sf):
    return round_df(st.qq_points(_returns(spark, sf), "returns"), {"sample": 9, "theoretical": 9})


@query("qq_line", _sql(_qq_sql() + "\nSELECT series, round(regr_slope(sample, theoretical), 9) AS slope, "
                       "round(regr_intercept(sample, theoretical), 9) AS intercept, round(corr(sample, theoretical), 9) AS r FROM qq GROUP BY series"
                       ).replace("\n, o AS", ", o AS"), ("TS5",))
def qq_line(spark, sf):
    return round_df(st.qq_line(st.qq_points(_returns(spark, sf), "returns")), {"slope": 9, "intercept": 9, "r": 9})
