import datetime as dt
import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillmark.operators import chartdata, correlation, describe, hypothesis, normality, quantiles, sampling, timeseries


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), float(rng.randint(0, 300)), rng.gauss(0, 1), 1.0) for _ in range(2000)]
    data += [("b", 7.0, 0.5, 1.0)] * 1000  # a third of the rows share one value
    data += [(None, 5.0, 1.0, 1.0), ("a", None, None, 1.0)]
    return data, spark.createDataFrame(data, "g string, x double, z double, k double").cache()


@pytest.fixture(params=[100_000, 20_000])
def either_path(request, monkeypatch):
    """Narrow brackets and wide ones."""
    monkeypatch.setattr(quantiles, "ACCURACY", request.param)


def test_quantiles_are_exact(spark, mixed, either_path):
    data, df = mixed
    probs = {"a": 0.0, "q": 0.25, "m": 0.5, "t": 0.9, "z": 1.0}
    got = {r["variable"]: r for r in quantiles.quantiles(df, ["x", "z", "k"], probs).collect()}
    for i, name in ((1, "x"), (2, "z"), (3, "k")):
        values = np.array([r[i] for r in data if r[i] is not None])
        assert got[name]["n"] == len(values)
        for key, p in probs.items():
            assert got[name][key] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("few", [3, 200_000])
def test_a_missed_bracket_opens(spark, mixed, monkeypatch, few):
    """Brackets of no width around coarse sketches miss their positions; whole results come all the same."""
    data, df = mixed
    frame = pd.DataFrame(data, columns=["g", "x", "z", "k"])
    monkeypatch.setattr(quantiles, "ACCURACY", 3)
    monkeypatch.setattr(quantiles, "REACHES", (1e-9, 1e-8))
    monkeypatch.setattr(quantiles, "LEAST_RANKS", 0)
    monkeypatch.setattr(quantiles, "FEW", few)
    opened = []
    monkeypatch.setattr(quantiles, "_opened", lambda *a, inner=quantiles._opened: opened.append(1) or inner(*a))
    settled = []
    monkeypatch.setattr(quantiles, "_settle", lambda *a, inner=quantiles._settle: settled.append(1) or inner(*a))
    probs = {"a": 0.01, "b": 0.37, "c": 0.5, "d": 0.993}
    got = {r["variable"]: r for r in quantiles.quantiles(df, ["x", "z"], probs).collect()}
    for name in ("x", "z"):
        for key, p in probs.items():
            assert got[name][key] == pytest.approx(np.quantile(frame[name].dropna(), p), abs=1e-12)
    grouped = {r["g"]: r["m"] for r in quantiles.quantiles(df, ["x"], {"m": 0.5}, by=["g"]).collect()}
    assert grouped == pytest.approx(frame.dropna(subset=["g"]).groupby("g")["x"].median().to_dict())
    assert len(settled) > 1 and (opened or few == 3)


def test_wide_brackets_are_narrowed(spark, mixed, monkeypatch):
    data, df = mixed
    frame = pd.DataFrame(data, columns=["g", "x", "z", "k"])
    monkeypatch.setattr(quantiles, "FEW", 5)
    monkeypatch.setattr(quantiles, "GRID", 8)
    narrowed = []
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a, inner=quantiles._narrowed: narrowed.append(1) or inner(*a))
    for name in ("x", "z"):
        got = quantiles.quantiles(df, [name], {"a": 0.1, "b": 0.9}).first()
        assert (got["a"], got["b"]) == pytest.approx((np.quantile(frame[name].dropna(), 0.1), np.quantile(frame[name].dropna(), 0.9)))
    got = {r["g"]: r["a"] for r in quantiles.quantiles(df, ["z"], {"a": 0.1}, by=["g"]).collect()}
    assert got == pytest.approx(frame.dropna(subset=["g"]).groupby("g")["z"].quantile(0.1).to_dict())
    assert narrowed


def test_grouped_quantiles(spark, mixed, either_path):
    data, df = mixed
    got = {r["g"]: r for r in quantiles.quantiles(df, ["x"], {"m": 0.5}, by=["g"]).collect()}
    assert set(got) == {"a", "b"}
    for g in "ab":
        assert got[g]["m"] == np.median([r[1] for r in data if r[0] == g and r[1] is not None])


def test_average_ranks(spark, mixed, either_path):
    data, df = mixed
    values = np.array([r[2] for r in data if r[2] is not None])
    got = {r["value"]: r["rank"] for r in quantiles.average_ranks(df, ["z"]).collect()}
    for v in (min(values), 0.5, max(values)):
        assert got[v] == (values < v).sum() + ((values == v).sum() + 1) / 2


def test_partitioning_does_not_matter(spark, mixed, either_path):
    _, df = mixed
    results = [
        sorted(rows(quantiles.quantiles(df.repartition(n), ["x", "z"], {"q": 0.3}))) for n in (1, 4, 50)
    ]
    assert results[0] == results[1] == results[2]


def test_approximate_quantiles(spark, mixed):
    _, df = mixed
    got = quantiles.approximate_quantiles(df, ["x"], {"m": 0.5}).first()
    exact = quantiles.quantiles(df, ["x"], {"m": 0.5}).first()
    assert got["m"] == exact["m"] and got["n"] == exact["n"]


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert rows(quantiles.median_value(df, "x")) == [(None,)]
    assert rows(describe.describe(df, ["x"])) == [("x", 0, *[None] * 9)]


def test_describe(spark, mixed):
    data, df = mixed
    got = {r["variable"]: r for r in describe.describe(df, ["x", "k"], digits=8).collect()}
    x = np.array([r[1] for r in data if r[1] is not None])
    n, m = len(x), x - x.mean()
    s2, s3, s4 = ((m**p).mean() for p in (2, 3, 4))
    assert got["x"]["count"] == n
    assert got["x"]["std"] == pytest.approx(x.std(ddof=1), abs=1e-7)
    assert got["x"]["skewness"] == pytest.approx(s3 / s2**1.5 * math.sqrt(n * (n - 1)) / (n - 2), abs=1e-7)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (s4 / s2**2 - 3) + 6)
    assert got["x"]["kurtosis"] == pytest.approx(kurt, abs=1e-7)
    constant = got["k"]
    assert (constant["std"], constant["skewness"], constant["kurtosis"], constant["p50"]) == (0.0, 0.0, 0.0, 1.0)


def test_describe_small_counts(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    got = describe.describe(df).first()
    assert got["skewness"] is None and got["kurtosis"] is None and got["std"] == pytest.approx(0.7071)
    assert describe.describe(df.limit(1)).first()["std"] is None


def test_shares_hours_and_shops(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 3, 10.0), ("a", 1.0, 4, 10.0), ("b", 2.0, 4, 0.0), (None, None, 5, 10.0)],
        "canal string, local double, hora int, monto_aplicado double",
    )
    assert rows(describe.value_shares(df, "canal")) == [("a", 2, 50.0), ("b", 1, 25.0)]
    assert rows(describe.peak_hours(df)) == [(3, 3)]
    hours = dict(rows(describe.hourly_sales(df)))
    assert len(hours) == 24 and hours[4] == 10.0 and hours[23] == 0.0
    shops = sorted(rows(describe.shop_totals(df)), key=str)
    assert shops == [(1.0, 0, 2, 20.0), (2.0, 0, 1, 0.0), (None, 1, 3, 20.0)]
    wide = sorted(rows(describe.contingency_wide(df, "local", "canal", ["a", "b"])))
    assert wide == [(1.0, 2, 0), (2.0, 0, 1)]
    maps = describe.partial_maps(df, "local", "canal", "monto_aplicado")
    assert dict(rows(describe.merge_partial_maps(maps, "parts"))) == {"a": 20.0, "b": 0.0}


def test_correlations(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 300).astype(float)
    y = x * 2 + rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y)], "x double, y double, k double")

    def rank(v):
        return np.array([(v < e).sum() + ((v == e).sum() + 1) / 2 for e in v])

    for method, expected in (("pearson", np.corrcoef(x, y)[0, 1]), ("spearman", np.corrcoef(rank(x), rank(y))[0, 1])):
        got = {(r["column_a"], r["column_b"]): r for r in correlation.correlation_with_pvalues(df, ["x", "y", "k"], method, 12).collect()}
        assert len(got) == 9
        assert got["x", "y"]["r"] == pytest.approx(expected, abs=1e-11)
        assert got["y", "x"]["r"] == got["x", "y"]["r"]
        assert (got["x", "x"]["r"], got["x", "x"]["p_value"]) == (1.0, 1.0)
        assert got["x", "k"]["r"] is None and got["x", "k"]["p_value"] is None
        assert got["k", "k"]["r"] is None and got["k", "k"]["p_value"] == 1.0


def test_shapiro_and_ks_of_known_sample(spark):
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    sample = spark.createDataFrame([("w", float(v)) for v in weights] + [("k", 1.0)] * 5, "variable string, value double")
    got = {r["variable"]: r for r in normality.assess_normality(sample).collect()}
    assert got["w"]["shapiro_w"] == pytest.approx(0.78881, abs=5e-5)
    assert got["w"]["shapiro_p"] == pytest.approx(0.006704, abs=5e-5)
    normal = statistics.NormalDist(statistics.mean(weights), statistics.stdev(weights))
    d = max(max((i + 1) / 11 - normal.cdf(v), normal.cdf(v) - i / 11) for i, v in enumerate(weights))
    assert got["w"]["ks_d"] == pytest.approx(d, abs=1e-12)
    assert got["k"]["shapiro_w"] is None and got["k"]["ks_p"] is None


def test_normality_and_method_choice(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(
        [(i, rng.gauss(10, 2), rng.expovariate(1), 1.0) for i in range(800)], "id long, normal double, skewed double, constant double"
    )
    got = normality.normality_tests(df, ["normal", "skewed", "constant"], ["id"])
    result = {r["variable"]: r for r in got.collect()}
    assert result["normal"]["shapiro_p"] > 0.05 > result["skewed"]["shapiro_p"]
    assert result["normal"]["shapiro_w"] > 0.99
    assert normality.correlation_method(got, ["normal", "skewed", "constant"]) == "spearman"
    assert normality.correlation_method(got.where("variable = 'normal'"), ["normal"]) == "pearson"


def test_chi_square(spark):
    cells = {("a", 1): 10, ("a", 2): 20, ("b", 1): 30, ("b", 2): 25, ("c", 1): 5, ("c", 2): 0}
    data = [(g, float(s)) for (g, s), n in cells.items() for _ in range(n)] + [(None, 1.0), ("a", None)]
    df = spark.createDataFrame(data, "canal string, local double")
    table = np.array([[10, 20], [30, 25], [5, 0]], float)
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    got = hypothesis.chi_square(df, "canal", "local").first()
    assert (got["n"], got["dof"]) == (90, 2)
    assert got["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    two = hypothesis.chi_square(df.where("canal != 'c'"), "canal", "local").first()
    t = table[:2]
    e = np.outer(t.sum(1), t.sum(0)) / t.sum()
    assert two["chi2"] == pytest.approx(((abs(t - e) - 0.5) ** 2 / e).sum())


def test_anova(spark):
    groups = {"a": [1.0, 2.0, 3.0], "b": [2.0, 4.0, 9.0, 5.0], "c": [10.0, 11.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [(None, 100.0)], "g string, x double")
    every = np.concatenate(list(groups.values()))
    between = sum(len(v) * (np.mean(v) - every.mean()) ** 2 for v in groups.values())
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    got = hypothesis.anova(df, "x", "g").first()
    assert got["f_statistic"] == pytest.approx((between / 2) / (within / 6))
    one = hypothesis.anova(df.where("g = 'a'"), "x", "g").first()
    assert one["f_statistic"] is None and one["error"] is not None and one["p_value"] is None


def test_two_groups(spark, either_path):
    a, b = [1.0, 2.0, 2.0, 5.0, 9.0, 9.0, 9.0, 3.0, 4.0], [2.0, 6.0, 7.0, 8.0, 9.0, 12.0, 13.0, 1.0, 5.0, 14.0]
    data = [("app", v) for v in a] + [("WEB", v) for v in b] + [("POS", 1.0), ("APP", None)]
    df = spark.createDataFrame(data, "canal string, x double")
    groups = hypothesis.two_groups(df, "x", hypothesis.channel_label("canal", "APP", "web"))
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    got = hypothesis.mann_whitney(groups, "x").first()
    assert (got["n_a"], got["n_b"], got["statistic"]) == (9, 10, u)
    pooled = a + b
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    z = (max(u, 90 - u) - 45 - 0.5) / math.sqrt(90 / 12 * (20 - ties / (19 * 18)))
    assert got["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    welch = hypothesis.welch_t(groups, "x").first()
    va, vb = np.var(a, ddof=1) / 9, np.var(b, ddof=1) / 10
    assert welch["statistic"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert welch["dof"] == pytest.approx((va + vb) ** 2 / (va**2 / 8 + vb**2 / 9))


def test_small_untied_groups_are_exact(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0)] + [("b", v) for v in (4.0, 5.0, 6.0)], "g string, x double")
    groups = hypothesis.two_groups(df, "x", F.col("g"))
    assert hypothesis.mann_whitney(groups, "x").first()["p_value"] == pytest.approx(0.1)
    short = hypothesis.mann_whitney(groups.where("g = 'a'"), "x").first()
    assert short["statistic"] is None and short["error"] == "not enough rows"


def test_published_rank_sum_p(spark):
    # sizes and U of the published comparison; ties are not published, so only four digits agree
    stat, na, nb = 1731339763.0, 43238.0, 79986.0
    z = (max(stat, na * nb - stat) - na * nb / 2 - 0.5) / math.sqrt(na * nb * (na + nb + 1) / 12)
    assert math.erfc(z / math.sqrt(2)) == pytest.approx(0.7217112216722581, abs=5e-5)


def test_compare_groups_picks_the_test(spark):
    rng = random.Random(2)
    normal = [(i, "APP" if i % 2 else "WEB", rng.gauss(5, 1)) for i in range(400)]
    df = spark.createDataFrame(normal, "id long, canal string, monto_aplicado double")
    label = hypothesis.channel_label("canal", "APP", "WEB")
    assert hypothesis.compare_groups(df, "monto_aplicado", label, ["id"]).first()["test"] == "Welch t-test"
    skewed = df.withColumn("monto_aplicado", F.exp("monto_aplicado"))
    got = hypothesis.compare_groups(skewed, "monto_aplicado", label, ["id"]).first()
    assert got["test"] == "Mann-Whitney U" and got["p_value"] > 0
    none = hypothesis.compare_groups(df.where("canal = 'APP'"), "monto_aplicado", label, ["id"]).first()
    assert none["error"] == "not enough rows" and none["statistic"] is None


def test_simple_regression(spark):
    x = [float(v) for v in range(20)]
    y = [3 + 2 * v + ((-1) ** int(v)) * 0.5 for v in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double").withColumn("k", F.lit(1.0))
    got = hypothesis.simple_regression(df, "y", "x").first()
    slope, intercept = np.polyfit(x, y, 1)
    assert (got["slope"], got["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    assert got["r_squared"] == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    assert hypothesis.simple_regression(df, "k", "x").first()["error"] is not None
    assert hypothesis.simple_regression(df.limit(9), "y", "x").first()["error"] is not None


def test_sample_is_the_lowest_hashes(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 2 == 0).alias("even"))
    by_brute_force = df.orderBy(sampling.row_hash(["k"])).limit(300)
    for n in (1, 7):
        assert sorted(rows(sampling.sample_rows(df.repartition(n), 300, ["k"]))) == sorted(rows(by_brute_force))
    assert sampling.sample_rows(df, 9000, ["k"]).count() == 5000
    halves = sampling.sample_rows(df, 300, ["k"], label="even", labels=[True, False])
    assert dict(rows(halves.groupBy("even").count())) == {True: 300, False: 300}
    assert rows(sampling.sample_rows(df, 5, ["k"], seed=8)) != rows(sampling.sample_rows(df, 5, ["k"], seed=9))


def test_split_is_stable(spark):
    df = spark.range(20000).select(F.col("id").alias("k"))
    first = rows(sampling.hash_split(df, ["k"]).where("is_train").orderBy("k"))
    again = rows(sampling.hash_split(df.repartition(13), ["k"]).where("is_train").orderBy("k"))
    assert first == again and 0.68 < len(first) / 20000 < 0.72


def series(spark, values, start=dt.date(2024, 1, 1)):
    data = [(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "day date, sales double")


def test_daily_series_fills_gaps(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", 5.0), ("2024-01-04 00:00:00", 2.0), ("2024-01-04 23:00:00", 3.0)], "t string, monto_aplicado double"
    ).select(F.col("t").cast("timestamp_ntz").alias("fecha"), "monto_aplicado")
    daily = timeseries.daily_sales(df)
    assert [r[1] for r in sorted(rows(daily))] == [5.0, 0.0, 0.0, 5.0]
    summary = timeseries.daily_summary(daily).first()
    assert summary["max_date"] == dt.date(2024, 1, 1) and summary["mean"] == 2.5


@pytest.mark.parametrize("period", [7, 4])
def test_decomposition(spark, period):
    rng = np.random.default_rng(0)
    x = rng.normal(size=30) + np.arange(30)
    weights = np.ones(7) / 7 if period == 7 else np.array([0.5, 1, 1, 1, 0.5]) / 4
    half = period // 2
    trend = np.full(30, np.nan)
    trend[half:-half] = np.convolve(x, weights, "valid")
    means = np.array([np.nanmean((x - trend)[i::period]) for i in range(period)])
    means -= means.mean()
    got = sorted(rows(timeseries.decompose(series(spark, x), period)))
    for i, (_, _, t, s, r) in enumerate(got):
        assert s == pytest.approx(means[i % period])
        assert (t is None) == bool(np.isnan(trend[i]))
        if t is not None:
            assert t == pytest.approx(trend[i]) and r == pytest.approx(x[i] - trend[i] - s)


def test_short_series_has_no_decomposition(spark):
    assert timeseries.decompose(series(spark, range(13))).count() == 0
    assert timeseries.decompose(series(spark, range(14))).count() == 14


def test_autocorrelations(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=100).cumsum()
    c = x - x.mean()
    r = np.array([(c[: 100 - k] * c[k:]).sum() / (c * c).sum() for k in range(41)])
    got = {row["lag"]: row for row in timeseries.autocorrelation(series(spark, x)).collect()}
    assert len(got) == 41
    for k in range(41):
        assert got[k]["acf"] == pytest.approx(r[k])
    width = 1.959963984540054 * math.sqrt((1 + 2 * (r[1:5] ** 2).sum()) / 100)
    assert got[5]["high"] - got[5]["acf"] == pytest.approx(width)
    assert got[0]["low"] == 1.0
    partial = {row["lag"]: row["pacf"] for row in timeseries.partial_autocorrelation(series(spark, x)).collect()}
    assert set(partial) == set(range(41))
    for k in (1, 2, 10, 40):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert partial[k] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1])
    few = timeseries.partial_autocorrelation(series(spark, x[:21]))
    assert few.agg(F.max("lag")).first()[0] == 9


def test_many_series_at_once(spark):
    rng = np.random.default_rng(4)
    parts = [series(spark, rng.normal(size=30)).withColumn("local", F.lit(i)) for i in range(3)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    together = timeseries.partial_autocorrelation(every, by=["local"]).where("local = 1").drop("local")
    alone = timeseries.partial_autocorrelation(parts[1].drop("local"))
    assert np.allclose(sorted(rows(together)), sorted(rows(alone)))


def test_histogram_and_density(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.gamma(2.0, 3.0, 1500), np.full(700, 4.0)])
    df = spark.createDataFrame([(float(v), 1.0) for v in x], "x double, k double")
    edges = np.histogram_bin_edges(x, bins="auto")
    counts, _ = np.histogram(x, bins=edges)
    got = {r["bin"]: r for r in chartdata.histogram(df, ["x", "k"]).where("variable = 'x'").collect()}
    assert {b: n for b, n in enumerate(counts) if n} == {b: r["n_rows"] for b, r in got.items()}
    assert got[0]["left"] == pytest.approx(edges[0]) and got[0]["right"] == pytest.approx(edges[1])
    assert sum(r["density"] * (r["right"] - r["left"]) for r in got.values()) == pytest.approx(1.0)
    constant = chartdata.histogram(df, ["k"]).first()
    assert (constant["left"], constant["right"], constant["n_rows"]) == (0.5, 1.5, len(x))
    curve = {r["point"]: r for r in chartdata.density_curve(df, ["x", "k"]).collect()}
    assert len(curve) == 200
    h = x.std(ddof=1) * len(x) ** -0.2
    at = x.min() + 30 * (x.max() - x.min()) / 199
    expected = np.exp(-(((at - x) / h) ** 2) / 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
    assert curve[30]["density"] == pytest.approx(expected, rel=1e-5)


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 5.0)] * 3 + [(None, 9.0)], "g string, x double")
    got = {r["g"]: tuple(r)[1:] for r in chartdata.box_statistics(df, "x", "g").collect()}
    assert got["a"] == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert got["b"] == (3, 5.0, 5.0, 5.0, 5.0, 5.0, 0)
    assert set(got) == {"a", "b"}


def test_median_of_counted_values(spark):
    """An even number of rows, an odd one, ties, nulls, and none."""
    for values in ([3.0, 1.0, 1.0, 8.0], [5.0, 5.0, 2.0], [7.0, None], [None], [1.0, 2.0, 2.0, 9.0, 9.5, 4.25]):
        counts = spark.createDataFrame([(v,) for v in values], "x double").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
        held = [v for v in values if v is not None]
        assert rows(quantiles.counted_median(counts, "x", "n")) == [(statistics.median(held) if held else None,)]


def test_sums_are_compiled(spark, monkeypatch):
    """The one scan for all sums has more fields than Spark compiles by itself."""
    from tillmark.operators import sums

    seen = []
    monkeypatch.setattr(sums, "materialize", lambda df, label: seen.append(df.sparkSession.conf.get("spark.sql.codegen.maxFields")) or df)
    sums.collect_sums(spark.range(5).toDF("x"), ["x"]).written()
    assert int(seen[0]) >= 1000 and int(spark.conf.get("spark.sql.codegen.maxFields", "100")) < 1000
