"""P-value columns against published statistics, closed forms and brute force."""

import itertools
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tillmark.functions import distributions as d


@pytest.fixture
def values(spark):
    def of(function, rows):
        """``function`` of each row of arguments, in one job."""
        names = [f"a{k}" for k in range(len(rows[0]))]
        data = [(i, *[None if a is None else float(a) for a in row]) for i, row in enumerate(rows)]
        found = spark.createDataFrame(data, ", ".join(["i int", *[f"{n} double" for n in names]]))
        return [r["p"] for r in sorted(found.select("i", function(*[F.col(n) for n in names]).alias("p")).collect())]

    return of


@pytest.fixture
def value(values):
    return lambda function, *arguments: values(function, [arguments])[0]


def test_f_tail_of_published_anova(value):
    assert value(d.f_p, 152.5529378513941, 3, 3242869 - 4) == pytest.approx(7.2575422209635095e-99, rel=1e-10)


def test_t_tail_of_published_regression(value):
    n, r2 = 3242869, 8.493881842532228e-05
    t = math.sqrt(r2 * (n - 2) / (1 - r2))
    assert value(d.t_p, t, n - 2) == pytest.approx(7.338959251801659e-62, rel=1e-8)


def test_published_coefficient_t(value):
    assert value(d.t_p, -611.200843733967 / 1076.010, 2270001) == pytest.approx(0.5700177257108164, abs=1e-4)


@pytest.mark.parametrize("d_stat, p", [(0.27559575873275355, 0.0), (0.19077942865289998, 7.570446819969075e-160)])
def test_ks_tail_of_published_samples(value, d_stat, p):
    assert value(d.ks_p, d_stat, 5000) == pytest.approx(p, rel=1e-9, abs=1e-300)


def test_ks_tail_meets_between_methods(value):
    edge = math.sqrt(3.0 / 2000)
    below, above = value(d.ks_p, edge * (1 - 1e-9), 2000), value(d.ks_p, edge * (1 + 1e-9), 2000)
    assert below == pytest.approx(above, rel=1e-4)
    assert value(d.ks_p, 0.27, 8) == pytest.approx(0.5199, abs=1e-3)
    assert value(d.ks_p, 0.0, 8) == 1.0 and value(d.ks_p, 1.0, 8) == 0.0


def test_normal_tail(value, spark):
    zs = [-39.0, -8.5, -3.0, -0.6, -0.0, 0.0, 1e-9, 0.5, 0.6628, 0.6630, 1.959963984540054, 5.656, 5.658, 9.0, 20.0, 37.0]
    found = spark.createDataFrame([(z,) for z in zs], "z double").select("z", d.normal_p("z").alias("p")).collect()
    for r in found:
        assert r["p"] == pytest.approx(0.5 * math.erfc(r["z"] / math.sqrt(2)), rel=2e-13)
    assert value(d.normal_p, None) is None and value(d.normal_p, float("nan")) is None


def test_normal_quantile(value, spark):
    ps = [1e-300, 1e-20, 1e-11, 1.4e-11, 0.001, 0.0749, 0.0751, 0.3, 0.5, 0.9, 0.924, 0.926, 0.975, 1 - 1e-12]
    found = spark.createDataFrame([(p,) for p in ps], "p double").select("p", d.normal_quantile("p").alias("z")).collect()
    for r in found:
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), rel=1e-14, abs=1e-15)
    assert value(d.normal_quantile, 0.0) is None and value(d.normal_quantile, 1.0) is None


def whole_chi2(x, dof):
    """Even degrees of freedom have a finite sum."""
    terms = [math.exp(k * math.log(x / 2) - x / 2 - math.lgamma(k + 1)) for k in range(int(dof) // 2)]
    return math.fsum(terms)


def test_chi2_tail_of_even_dof(values):
    rows = [(dof * share, dof) for dof in (2, 4, 30, 600, 20_000) for share in (0.01, 0.5, 0.98, 1, 1.001, 1.02, 1.5, 3)]
    for row, p in zip(rows, values(d.chi2_p, rows)):
        assert p == pytest.approx(whole_chi2(*row), rel=1e-9, abs=1e-300), row


def whole_f(f, d1, d2):
    """Even numerator degrees of freedom have a finite sum: a binomial tail of real length."""
    x = d2 / (d2 + d1 * f)
    a, b = d2 / 2, d1 // 2
    return math.fsum(math.exp(a * math.log(x) + k * math.log1p(-x) + math.lgamma(a + k) - math.lgamma(a) - math.lgamma(k + 1)) for k in range(b))


def test_f_tail_of_even_dof(values):
    dofs = [(2, 1), (2, 7), (4, 3.5), (40, 33), (600, 50), (50, 2000), (2372, 500)]
    rows = [(f, d1, d2) for d1, d2 in dofs for f in (1e-6, 0.01, 0.5, 0.97, 1.0, 1.03, 2.0, 8.0, 1e6)]
    for row, p in zip(rows, values(d.f_p, rows)):
        assert p == pytest.approx(whole_f(*row), rel=1e-9, abs=1e-300), row


def test_t_tail_of_one_and_two_dof(values):
    ts = (0.001, 0.3, 1.0, 1.7, 1.8, 12.0, 1e6)
    for t, p in zip(ts, values(d.t_p, [(t, 1) for t in ts])):
        assert p == pytest.approx(2 * math.atan2(1, t) / math.pi, rel=1e-13)
    for t, p in zip(ts, values(d.t_p, [(-t, 2) for t in ts])):
        root = math.sqrt(2 + t * t)
        assert p == pytest.approx(2 / (root * (root + t)), rel=1e-13)


def test_t_tail_nears_the_normal_one(values):
    rows = [(t, dof) for dof in (1e6, 1e8, 1e10) for t in (0.1, 1.73, 1.74, 4.0)]
    for (t, dof), p in zip(rows, values(d.t_p, rows)):
        assert p == pytest.approx(math.erfc(t / math.sqrt(2)), rel=100 / dof + 1e-11)


def test_table_values(value):
    assert value(d.chi2_p, 3.841458820694124, 1) == pytest.approx(0.05, rel=1e-12)
    assert value(d.chi2_p, 3242869.0, 2373) == 0.0
    assert value(d.chi2_p, 0.0, 3) == 1.0
    assert value(d.f_p, 0.0, 3, 10) == 1.0
    assert value(d.f_p, float("inf"), 1, 10) == 0.0
    assert value(d.t_p, float("inf"), 10) == 0.0 and value(d.t_p, None, 10) is None and value(d.f_p, float("nan"), 1, 2) is None


def test_t_quantiles(value, values):
    published = {1: math.tan(math.pi * 0.475), 2: 4.302652729749464, 3: 3.182446305284263, 4: 2.7764451051977987, 10: 2.2281388519649385, 30: 2.0422724563012373}
    for t, found in zip(published.values(), values(d.t_critical, [(0.975, dof) for dof in published])):
        assert found == pytest.approx(t, rel=1e-10)
    rows = [(p, dof) for p in (0.9, 0.995, 0.99999) for dof in (1, 2, 3, 7.5, 1000, 5e6)]
    ts = values(d.t_critical, rows)
    for (p, _), tail in zip(rows, values(d.t_p, [(t, dof) for t, (_, dof) in zip(ts, rows)])):
        assert tail == pytest.approx(2 * (1 - p), rel=1e-8)
    assert value(d.t_critical, 0.975, 5e6) == pytest.approx(1.959964, abs=1e-5)


def test_columns_are_expressions(spark):
    row = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    found = row.select(d.normal_p("a"), d.normal_quantile("a"), d.chi2_p("a", "b"), d.t_p("a", "b"), d.f_p("a", "b", "c"), d.t_critical(F.lit(0.975), "b"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_rank_sum_exact_tail_by_enumeration():
    for n1, n2 in ((3, 6), (4, 5), (2, 2)):
        stats = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, n1 + n2 + 1), n1)]
        for u in range(n1 * n2 + 1):
            expected = sum(s >= u for s in stats) / len(stats)
            assert d.rank_sum_exact_tail(u, n1, n2) == pytest.approx(expected)


def test_rank_sum_exact_tail_has_no_size_limit():
    assert d.rank_sum_exact_tail(0, 8, 10**9) == 1.0
    below, above = (d.rank_sum_exact_tail(0.9 * 8 * n, 8, n) for n in (624_999, 625_001))
    assert below == pytest.approx(above, rel=1e-4) and 0 < below < 1e-3
    # the mean of eight uniforms, as the larger group grows
    assert d.rank_sum_exact_tail(4 * 10**12, 8, 10**12) == pytest.approx(0.5, abs=1e-6)
