"""Distribution functions as JVM column expressions (no Python in the hot path).

Each formula is written once against an ``ops`` namespace, so the same
arithmetic yields a Spark ``Column`` (``SparkOps``) or SQL text for the DuckDB
oracle (``SqlOps``).

* ``norm_cdf``: Hart's double-precision algorithm as published by G. West,
  "Better approximations to cumulative normal functions" (2005).
* ``norm_ppf``: inverse normal, algorithm AS 241 (Wichura, 1988), about 1e-16.
* ``chi2_sf``: closed forms for integer degrees of freedom (even: Poisson sum;
  odd: normal tail + finite sum), unrolled up to ``max_df``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


class SparkOps:
    @staticmethod
    def lit(x):
        return F.lit(float(x))

    exp = staticmethod(F.exp)
    sqrt = staticmethod(F.sqrt)
    abs = staticmethod(F.abs)
    ln = staticmethod(F.ln)

    @staticmethod
    def when(cond, a, b):
        return F.when(cond, a).otherwise(b)

    @staticmethod
    def cbrt(x):
        return F.cbrt(x)

    @staticmethod
    def asinh(x):
        return F.asinh(x)

    @staticmethod
    def sign(x):
        return F.signum(x)


class S:
    """SQL text with arithmetic operators."""

    def __init__(self, text):
        self.t = text if isinstance(text, str) else repr(float(text))

    @staticmethod
    def _w(o):
        return o if isinstance(o, S) else S(o)

    def _bin(self, op, o, rev=False):
        o = S._w(o)
        return S(f"({o.t} {op} {self.t})") if rev else S(f"({self.t} {op} {o.t})")

    def __add__(self, o): return self._bin("+", o)
    def __radd__(self, o): return self._bin("+", o, True)
    def __sub__(self, o): return self._bin("-", o)
    def __rsub__(self, o): return self._bin("-", o, True)
    def __mul__(self, o): return self._bin("*", o)
    def __rmul__(self, o): return self._bin("*", o, True)
    def __truediv__(self, o): return self._bin("/", o)
    def __rtruediv__(self, o): return self._bin("/", o, True)
    def __neg__(self): return S(f"(-{self.t})")
    def __gt__(self, o): return self._bin(">", o)
    def __lt__(self, o): return self._bin("<", o)
    def __ge__(self, o): return self._bin(">=", o)
    def __le__(self, o): return self._bin("<=", o)
    def __pow__(self, o): return S(f"pow({self.t}, {S._w(o).t})")

    def __str__(self):
        return self.t


class SqlOps:
    @staticmethod
    def lit(x):
        return S(f"CAST({float(x)!r} AS DOUBLE)")

    @staticmethod
    def exp(x): return S(f"exp({x})")

    @staticmethod
    def sqrt(x): return S(f"sqrt({x})")

    @staticmethod
    def abs(x): return S(f"abs({x})")

    @staticmethod
    def ln(x): return S(f"ln({x})")

    @staticmethod
    def when(cond, a, b): return S(f"(CASE WHEN {cond} THEN {S._w(a)} ELSE {S._w(b)} END)")

    @staticmethod
    def cbrt(x): return S(f"cbrt({x})")

    @staticmethod
    def asinh(x): return S(f"ln({x} + sqrt({x} * {x} + 1))")

    @staticmethod
    def sign(x): return S(f"sign({x})")


# Fixed coefficients of Hart's algorithm (West 2005, figure 2).
_HART_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376)
_HART_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
             296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _horner(coefs, x, ops):
    acc = ops.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + ops.lit(c)
    return acc


def norm_sf_pos(xabs, ops):
    """Upper normal tail for |x| (x >= 0)."""
    e = ops.exp(-(xabs * xabs) / ops.lit(2.0))
    near = e * _horner(_HART_NUM, xabs, ops) / _horner(_HART_DEN, xabs, ops)
    b = xabs + ops.lit(0.65)
    b = xabs + ops.lit(4.0) / b
    b = xabs + ops.lit(3.0) / b
    b = xabs + ops.lit(2.0) / b
    b = xabs + ops.lit(1.0) / b
    far = e / b / ops.lit(2.506628274631)
    tail = ops.when(xabs < ops.lit(7.07106781186547), near, far)
    return ops.when(xabs > ops.lit(37.0), ops.lit(0.0), tail)


def norm_cdf(x, ops=SparkOps):
    t = norm_sf_pos(ops.abs(x), ops)
    return ops.when(x > ops.lit(0.0), ops.lit(1.0) - t, t)


def chi2_sf(x, df: int, ops=SparkOps):
    """Survival function of chi-square with an integer (literal) ``df``."""
    half = x / ops.lit(2.0)
    if df % 2 == 0:
        term, total = ops.lit(1.0), ops.lit(1.0)
        for i in range(1, df // 2):
            term = term * half / ops.lit(i)
            total = total + term
        return ops.exp(-half) * total
    root = ops.sqrt(x)
    out = ops.lit(2.0) * norm_sf_pos(root, ops)
    if df > 1:
        term = root
        total = root
        for i in range(2, (df - 1) // 2 + 1):
            term = term * x / ops.lit(2 * i - 1)
            total = total + term
        out = out + ops.lit(math.sqrt(2.0 / math.pi)) * ops.exp(-half) * total
    return out


def chi2_sf_var(x, df_col, max_df: int, ops=SparkOps):
    """chi2_sf with a per-row df in 1..max_df (CASE over the literal forms)."""
    if ops is SparkOps:
        out = F.lit(None).cast("double")
        for d in range(max_df, 0, -1):
            out = F.when(df_col == d, chi2_sf(x, d, ops)).otherwise(out)
        return out
    parts = " ".join(f"WHEN {df_col} = {d} THEN {chi2_sf(x, d, ops)}" for d in range(1, max_df + 1))
    return S(f"(CASE {parts} END)")


def z_two_sided(alpha: float = 0.05) -> float:
    """Normal quantile 1 - alpha/2 (1.959963984540054 for 0.05)."""
    from statistics import NormalDist
    return NormalDist().inv_cdf(1 - alpha / 2)


# ---------------------------------------------------------------------------
# Normality tests on moments (n, g1 = m3/m2^1.5, b2 = m4/m2^2)
# ---------------------------------------------------------------------------

def skewtest_z(n, g1, ops=SparkOps):
    """D'Agostino skewness z (needs n >= 8)."""
    L = ops.lit
    y = g1 * ops.sqrt((n + L(1)) * (n + L(3)) / (L(6) * (n - L(2))))
    beta2 = (L(3) * (n * n + L(27) * n - L(70)) * (n + L(1)) * (n + L(3))
             / ((n - L(2)) * (n + L(5)) * (n + L(7)) * (n + L(9))))
    w2 = L(-1) + ops.sqrt(L(2) * (beta2 - L(1)))
    delta = L(1) / ops.sqrt(L(0.5) * ops.ln(w2))
    alpha = ops.sqrt(L(2) / (w2 - L(1)))
    return delta * ops.asinh(y / alpha)


def kurtosistest_z(n, b2, ops=SparkOps):
    """Anscombe-Glynn kurtosis z (b2 = population kurtosis, not excess)."""
    L = ops.lit
    e = L(3) * (n - L(1)) / (n + L(1))
    varb2 = L(24) * n * (n - L(2)) * (n - L(3)) / ((n + L(1)) * (n + L(1)) * (n + L(3)) * (n + L(5)))
    x = (b2 - e) / ops.sqrt(varb2)
    sb1 = (L(6) * (n * n - L(5) * n + L(2)) / ((n + L(7)) * (n + L(9)))
           * ops.sqrt(L(6) * (n + L(3)) * (n + L(5)) / (n * (n - L(2)) * (n - L(3)))))
    a = L(6) + L(8) / sb1 * (L(2) / sb1 + ops.sqrt(L(1) + L(4) / (sb1 * sb1)))
    term1 = L(1) - L(2) / (L(9) * a)
    denom = L(1) + x * ops.sqrt(L(2) / (a - L(4)))
    term2 = ops.sign(denom) * ops.cbrt((L(1) - L(2) / a) / ops.abs(denom))
    return (term1 - term2) / ops.sqrt(L(2) / (L(9) * a))


# MacKinnon (1994) approximate p-value, constant-only ADF regression, one series.
# Fixed values of the published response surface.
ADF_C_SMALLP = (2.1659, 1.4412, 0.038269)
ADF_C_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_C_TAU_MAX, ADF_C_TAU_MIN, ADF_C_TAU_STAR = 2.74, -18.83, -1.61


def adf_pvalue(tau, ops=SparkOps):
    L = ops.lit
    small = L(ADF_C_SMALLP[0]) + L(ADF_C_SMALLP[1]) * tau + L(ADF_C_SMALLP[2]) * tau * tau
    large = (L(ADF_C_LARGEP[0]) + L(ADF_C_LARGEP[1]) * tau + L(ADF_C_LARGEP[2]) * tau * tau
             + L(ADF_C_LARGEP[3]) * tau * tau * tau)
    p = ops.when(tau <= L(ADF_C_TAU_STAR), norm_cdf(small, ops), norm_cdf(large, ops))
    return ops.when(tau > L(ADF_C_TAU_MAX), L(1.0), ops.when(tau < L(ADF_C_TAU_MIN), L(0.0), p))



# Coefficients of AS 241 (PPND16), highest power first.
PPF_CENTRE = ((2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
               1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
              (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
               5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0))
PPF_TAIL = ((7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
             3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
            (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
             6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0))
PPF_FAR = ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
            2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
           (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
            1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0))


def ppf_tail_root(p, ops=SparkOps):
    """The argument of the tail polynomials; where they are not used, any defined value."""
    q = p - 0.5
    return ops.sqrt(-ops.ln(ops.when(ops.abs(q) <= 0.425, ops.lit(0.5), ops.when(q < 0, p, 1.0 - p))))


def norm_ppf(p, r, ops=SparkOps):
    """Inverse of the standard normal CDF for 0 < p < 1, with ``r = ppf_tail_root(p)``. Both should
    be columns of their own: they occur in every term."""
    def ratio(coefficients, r):
        out = []
        for poly in coefficients:
            acc = ops.lit(poly[0])
            for c in poly[1:]:
                acc = acc * r + ops.lit(c)
            out.append(acc)
        return out[0] / out[1]

    q = p - 0.5
    tail = ops.when(r <= 5.0, ratio(PPF_TAIL, r - 1.6), ratio(PPF_FAR, r - 5.0))
    return ops.when(ops.abs(q) <= 0.425, ratio(PPF_CENTRE, 0.180625 - q * q) * q, ops.when(q < 0, -tail, tail))
