"""Tail probabilities and quantiles as column expressions.

Incomplete gamma and beta functions are continued fractions or series, run by ``aggregate`` over as many steps as the
arguments may need; a step after convergence keeps its state. What stands before them, powers over gamma functions,
is taken from deviations of the arguments from the peak, so it keeps its digits at any degrees of freedom.
A null or NaN argument gives null. Two exact counts that are no expression, of ranks and of small
Kolmogorov-Smirnov statistics, are Pandas UDFs over result rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.expressions import polynomial

# Rational approximations of the error function published by Cody (1969), numerator and denominator, constant term first.
ERF_NEAR = (
    (3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02, 3.16112374387056560e00, 1.85777706184603153e-1),
    (2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02, 2.36012909523441209e01, 1.0),
)
ERFC_MIDDLE = (
    (1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03, 8.81952221241769090e02, 2.98635138197400131e02,
     6.61191906371416295e01, 8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8),
    (1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03, 3.29079923573345963e03, 1.62138957456669019e03,
     5.37181101862009858e02, 1.17693950891312499e02, 1.57449261107098347e01, 1.0),
)
ERFC_FAR = (
    (6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1, 3.60344899949804439e-1, 3.05326634961232344e-1, 1.63153871373020978e-2),
    (2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1, 1.87295284992346725e00, 2.56852019228982242e00, 1.0),
)
# The normal quantile published by Wichura (1988), algorithm AS 241 (PPND16), in the same form.
QUANTILE_MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
QUANTILE_OUTER = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
QUANTILE_FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
# Stirling's series of the logarithm of the gamma function, in odd powers of 1 / z.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)

ROOT_PI = math.sqrt(math.pi)
#: Arguments below this are raised by as much before Stirling's series is used.
SHIFT = 16
CONVERGED = 4e-16
#: From n d² above this twice the one-sided tail of a Kolmogorov-Smirnov statistic is the two-sided one to double precision.
KS_ONE_SIDED = 3.0


def _double(value: Column | float | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(float(value))).cast("double")


def _bound(body: Callable[..., Column], *values: Column | float | str) -> Column:
    """``body`` of the values, each worked out once; null if one of them is null or NaN."""
    columns = [F.nanvl(_double(v), F.lit(None).cast("double")) for v in values]
    packed = F.struct(*[c.alias(f"v{k}") for k, c in enumerate(columns)])
    known = lambda s: [s[f"v{k}"] for k in range(len(columns))]

    def inner(s: Column) -> Column:
        complete = functools.reduce(lambda a, b: a & b, [v.isNotNull() for v in known(s)])
        return F.when(complete, body(*known(s)))

    return F.get(F.transform(F.array(packed), inner), F.lit(0))


def _rational(pair: tuple[Sequence[float], Sequence[float]], x: Column) -> Column:
    return polynomial(pair[0], x) / polynomial(pair[1], x)


def _fraction(first: Column, step: Callable[[Column], tuple[Column, Column]], count: Column) -> Column:
    """first + a1 / (b1 + a2 / (b2 + ...)), ``step`` of i giving (a_i, b_i); null if ``count`` steps do not settle it.

    ``v`` is the value of the fraction cut after a step, ``w`` and ``r`` the numerator and denominator of the
    fraction before, both over the denominator of this one.
    """
    one, zero = F.lit(1.0), F.lit(0.0)
    start = F.struct(first.alias("v"), one.alias("w"), zero.alias("r"), F.lit(False).alias("done"))

    def advance(state: Column, i: Column) -> Column:
        a, b = step(i.cast("double"))
        grown = b + a * state["r"]
        value = (b * state["v"] + a * state["w"]) / grown
        settled = F.abs(value - state["v"]) <= CONVERGED * F.abs(value)
        moved = F.struct(value.alias("v"), (state["v"] / grown).alias("w"), (one / grown).alias("r"), settled.alias("done"))
        return F.when(state["done"], state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), count.cast("int")), start, advance, lambda s: F.when(s["done"], s["v"]))


def _stirling_rest(z: Column) -> Column:
    """ln Γ(z + 1) less (z + 1/2) ln z - z + ln(2π) / 2."""

    def series(x: Column) -> Column:
        return polynomial(STIRLING, 1 / (x * x)) / x

    raised = z + F.lit(float(SHIFT))
    product = functools.reduce(lambda a, b: a * b, [z + F.lit(float(k)) for k in range(1, SHIFT + 1)])
    shifted = series(raised) + (raised + 0.5) * F.log(raised) - F.lit(float(SHIFT)) - F.log(product) - (z + 0.5) * F.log(z)
    return F.when(z < SHIFT, shifted).otherwise(series(z))


def _fall(u: Column, ratio: Column) -> Column:
    """u - ln(1 + u), with ``ratio`` = 1 + u given apart: how far a power over its gamma function falls beside its peak."""
    return u - F.when(F.abs(u) < 0.5, F.log1p(u)).otherwise(F.log(ratio))


def _gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x)."""

    def inner(a: Column, x: Column, before: Column) -> Column:
        count = F.lit(400) + 10 * F.sqrt(a)
        fraction = _fraction(x + 1 - a, lambda i: (-i * (i - a), x + 2 * i + 1 - a), count)
        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

        def add(state: Column, k: Column) -> Column:
            term = state["term"] * x / (a + k)
            return F.when(state["term"] < 1e-17 * state["sum"], state).otherwise(F.struct(term.alias("term"), (state["sum"] + term).alias("sum")))

        series = F.aggregate(F.sequence(F.lit(1), count.cast("int")), start, add, lambda s: s["sum"])
        return F.when(x <= 0, 1.0).when(x < a + 1, F.greatest(F.lit(0.0), 1 - before * series / a)).otherwise(before / fraction)

    before = F.sqrt(a / (2 * math.pi)) * F.exp(-_stirling_rest(a) - a * _fall((x - a) / a, x / a))
    return _bound(inner, a, x, F.when(x > 0, before).otherwise(0.0))


def _beta_peak(a: Column, b: Column, x: Column, y: Column) -> Column:
    """x^a y^b / B(a, b) for y = 1 - x, both above zero."""
    rests = _stirling_rest(a + b) - _stirling_rest(a) - _stirling_rest(b)
    falls = a * _fall((b * x - a * y) / a, (a + b) * x / a) + b * _fall((a * y - b * x) / b, (a + b) * y / b)
    return F.sqrt(a * b / ((a + b) * (2 * math.pi))) * F.exp(rests - falls)


def _beta_lower(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), with y = 1 - x given apart so that it keeps its digits."""

    def share(a: Column, b: Column, x: Column, y: Column, peak: Column) -> Column:
        def below(m: Column) -> Column:
            return m + m * (b - m) * x / (a + 2 * m - 1) + (a + m) * (a * y - b * x + 1 + m * (2 - x)) / (a + 2 * m + 1)

        def step(m: Column) -> tuple[Column, Column]:
            wide = a + 2 * m - 1
            return m * ((a + m - 1) / wide) * ((a + b + m - 1) / wide) * (b - m) * x * x, below(m)

        first = a * (a * y - b * x + 1) / (a + 1)
        return peak / _fraction(first, step, F.lit(400) + 6 * F.sqrt(F.least(a, b)))

    def inner(a: Column, b: Column, x: Column, y: Column) -> Column:
        swapped = x > (a + 1) / (a + b + 2)
        either = lambda p, q: F.when(swapped, q).otherwise(p)
        part = _bound(share, either(a, b), either(b, a), either(x, y), either(y, x), _beta_peak(a, b, x, y))
        return F.when(x <= 0, 0.0).when(y <= 0, 1.0).when(swapped, 1 - part).otherwise(part)

    return _bound(inner, a, b, x, y)


def normal_p(z: Column | str) -> Column:
    """P(Z > z)."""

    def inner(z: Column, x: Column, square: Column) -> Column:
        near = 1 - x * _rational(ERF_NEAR, square)
        middle = F.exp(-square) * _rational(ERFC_MIDDLE, x)
        far = F.exp(-square) / x * (1 / ROOT_PI - _rational(ERFC_FAR, 1 / square) / square)
        upper = F.when(x <= 0.46875, near).when(x <= 4, middle).otherwise(far) / 2
        return F.when(z < 0, 1 - upper).otherwise(upper)

    z = _double(z)
    return _bound(inner, z, F.abs(z) / math.sqrt(2), z * z / 2)


def normal_quantile(p: Column | str) -> Column:
    """z with P(Z <= z) = p, null outside 0 < p < 1."""

    def inner(p: Column, q: Column, r: Column) -> Column:
        tail = F.when(r <= 5, _rational(QUANTILE_OUTER, r - 1.6)).otherwise(_rational(QUANTILE_FAR, r - 5.0))
        middle = q * _rational(QUANTILE_MIDDLE, 0.180625 - q * q)
        return F.when(F.abs(q) <= 0.425, middle).when(q < 0, -tail).otherwise(tail)

    p = _double(p)
    p = F.when((p > 0) & (p < 1), p)
    return _bound(inner, p, p - 0.5, F.sqrt(-F.log(F.least(p, 1 - p))))


def chi2_p(x: Column | str, dof: Column | str) -> Column:
    """P(X >= x) of a chi-square variable."""
    return _bound(lambda x, dof: _gamma_upper(dof / 2, x / 2), x, dof)


def f_p(f: Column | str, d1: Column | str, d2: Column | str) -> Column:
    """P(F >= f)."""

    def inner(f: Column, d1: Column, d2: Column) -> Column:
        total = d2 + d1 * f
        return F.when(f <= 0, 1.0).when(f == float("inf"), 0.0).otherwise(_beta_lower(d2 / 2, d1 / 2, d2 / total, d1 * f / total))

    return _bound(inner, f, d1, d2)


def t_p(t: Column | str, dof: Column | str) -> Column:
    """P(|T| >= |t|)."""
    return _bound(lambda t, dof: f_p(t * t, F.lit(1.0), dof), t, dof)


def t_critical(p: Column | str, dof: Column | str) -> Column:
    """t with P(T <= t) = p, for p above 1/2: the expansion of Cornish and Fisher, then Newton's steps on the
    logarithm of the tail by that of t, which is nearly a line."""

    def inner(p: Column, dof: Column, z: Column) -> Column:
        square = z * z
        first = z * polynomial((1, 1), square) / (4 * dof)
        second = z * polynomial((3, 16, 5), square) / (96 * dof**2)
        third = z * polynomial((-15, 17, 19, 3), square) / (384 * dof**3)
        start = F.when(dof < 1.5, F.tan(math.pi * (p - 0.5))).when(dof < 2.5, (2 * p - 1) * F.sqrt(F.lit(2.0)) / F.sqrt(4 * p * (1 - p))).otherwise(z + first + second + third)

        def newton(t: Column, _: Column) -> Column:
            total = dof + t * t
            steepness = _beta_peak(dof / 2, F.lit(0.5), dof / total, t * t / total)  # t times the density
            return _bound(lambda t, tail, steepness: t * F.exp(F.log(tail / (1 - p)) * tail / steepness), t, t_p(t, dof) / 2, steepness)

        return F.aggregate(F.sequence(F.lit(1), F.lit(6)), start, newton)

    return _bound(inner, p, dof, normal_quantile(p))


def _ks_far(d: Column, n: Column) -> Column:
    """Twice the exact one-sided tail, its binomial coefficients carried along in logarithms."""

    def inner(d: Column, n: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("choose"))

        def add(state: Column, j: Column) -> Column:
            share = j / n
            rest = 1 - d - share
            term = F.exp(state["choose"] + (j - 1) * F.log(d + share) + (n - j) * F.log(rest))
            more = F.when(rest > 0, term).otherwise(0.0)
            return F.struct((state["sum"] + more).alias("sum"), (state["choose"] + F.log((n - j) / (j + 1))).alias("choose"))

        steps = F.sequence(F.lit(0), F.least(F.floor(n * (1 - d)), n - 1).cast("int"))
        return F.least(F.lit(1.0), 2 * d * F.aggregate(steps, start, add, lambda s: s["sum"]))

    return _bound(inner, d, n)


def ks_small_tail(d: float, n: int) -> float:
    """P(D >= d) of a small two-sided one-sample Kolmogorov-Smirnov statistic, by the exact matrix power."""
    if d <= 0:
        return 1.0
    n = int(n)
    k = int(math.floor(n * d)) + 1
    m, h = 2 * k - 1, k - n * d
    size = np.arange(m)
    band = size[:, None] - size[None, :] + 1
    grid = (band >= 0).astype(float)
    powers = h ** (size + 1.0)
    grid[:, 0] -= powers
    grid[-1, :] -= powers[::-1]
    grid[-1, 0] += max(0.0, 2 * h - 1) ** m
    grid /= np.array([[math.factorial(v) if 0 <= v < 170 else math.inf for v in row] for row in band], dtype=float)
    power, result, log10_power, log10_result, e = grid, np.eye(m), 0, 0, n
    while e:
        if e & 1:
            result, log10_result = result @ power, log10_result + log10_power
        power, log10_power = power @ power, 2 * log10_power
        if power[k - 1, k - 1] > 1e140:
            power, log10_power = power * 1e-140, log10_power + 140
        if result[k - 1, k - 1] > 1e140:
            result, log10_result = result * 1e-140, log10_result + 140
        e >>= 1
    middle = result[k - 1, k - 1]
    if middle <= 0:
        return 1.0
    log_scale = math.lgamma(n + 1) - n * math.log(n) + log10_result * math.log(10)
    return float(min(1.0, max(0.0, 1.0 - math.exp(math.log(middle) + log_scale))))


@functools.cache
def _parts_polynomial(m: int) -> tuple[int, list[int]]:
    """Period L and numerator N with N(q) / (1 - q^L)^(m + 1) = 1 / ((1 - q) (1 - q) (1 - q^2) ... (1 - q^m))."""
    period = math.lcm(*range(1, m + 1))
    numerator = [1]
    for i in (1, *range(1, m + 1)):
        raised = [0] * (len(numerator) + period - i)
        for start in range(0, period, i):
            for k, c in enumerate(numerator):
                raised[k + start] += c
        numerator = raised
    return period, numerator


def _sums_up_to(total: int, m: int) -> int:
    """Number of sums up to ``total`` of parts of sizes 1 to m."""
    if total < 0:
        return 0
    period, numerator = _parts_polynomial(m)
    return sum(numerator[j] * math.comb((total - j) // period + m, m) for j in range(total % period, min(total + 1, len(numerator)), period))


def rank_sum_exact_tail(u: float, n1: int, n2: int) -> float:
    """P(U >= u) without ties, for a smaller group of at most 8 and a larger one of any size.

    Counts, in whole numbers, the ways to reach n1 * n2 - u or less, from the generating function
    prod (1 - q^(large + i)) / (1 - q^i): its numerator has 2^small terms, and each needs one
    closed-form count.
    """
    small, large = sorted((int(n1), int(n2)))
    rest = small * large - math.ceil(u)
    terms = {0: 1}
    for i in range(1, small + 1):
        for power, sign in list(terms.items()):
            terms[power + large + i] = terms.get(power + large + i, 0) - sign
    reached = sum(sign * _sums_up_to(rest - power, small) for power, sign in terms.items() if power <= rest)
    return float(Fraction(reached, math.comb(small + large, small)))


def _scalar(function: Callable[..., float]) -> Callable[..., Column]:
    """Pandas UDF of two or three columns that applies a scalar function and keeps nulls."""

    def rows(*columns: pd.Series) -> pd.Series:
        values = [None if any(v is None or v != v for v in row) else float(function(*row)) for row in zip(*columns)]
        return pd.Series(values, dtype="float64")

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return rows(a, b)

    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return rows(a, b, c)

    return F.pandas_udf({2: two, 3: three}[function.__code__.co_argcount], T.DoubleType())


_ks_near = _scalar(ks_small_tail)
rank_sum_exact_p = _scalar(rank_sum_exact_tail)


def ks_p(d: Column | str, n: Column | str) -> Column:
    """P(D >= d) of the two-sided one-sample Kolmogorov-Smirnov statistic of n values."""
    d, n = _double(d), _double(n)
    far = n * d * d > KS_ONE_SIDED
    return F.when(d >= 1, 0.0).when(far, _ks_far(d, n)).otherwise(_ks_near(F.when(~far, d), n))
