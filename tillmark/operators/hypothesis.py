"""Hypothesis tests: distributed sufficient statistics, then a p-value on one row."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.distributions import chi2_p, f_p, normal_p, rank_sum_exact_p, t_p
from tillmark.functions.expressions import ratio
from tillmark.operators.correlation import pearson, r_to_t
from tillmark.operators.describe import contingency
from tillmark.operators.normality import MAX_SAMPLE, assess_normality
from tillmark.operators.quantiles import cumulative_counts, value_counts
from tillmark.operators.sampling import DEFAULT_SEED, row_hash, sample_rows
from tillmark.operators.sums import Sums, collect_sums, cross_of, joint, m2_of, mean_of

LEVEL = 0.05
EXACT_GROUP = 8
MIN_REGRESSION_ROWS = 10
#: Keys of the statistics behind the battery; each has few values.
BATTERY_KEYS = ("canal", "es_fin_de_semana", "genero")
# The result keys of the five hypotheses.
HYPOTHESES = (
    "H1_ticket_app_vs_web", "H2_descuento_vs_volumen", "H3_monto_finde_vs_semana", "H4_edad_vs_monto", "H5_genero_vs_monto",
)


def significant(p: str = "p_value") -> Column:
    return (F.col(p) < LEVEL).alias("significant")


# chi-square -----------------------------------------------------------------


def chi_square_statistic(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """One row: n, chi2 and dof. A 2x2 table gets the continuity correction.

    Works on the cells that occur: chi2 = n (sum o^2 / (r k) - 1).
    """
    cells = contingency(df, rows, columns)
    row_totals = cells.groupBy(rows).agg(F.sum("n_rows").cast("double").alias("r"))
    column_totals = cells.groupBy(columns).agg(F.sum("n_rows").cast("double").alias("k"))
    o = F.col("n_rows").cast("double")
    cell_sums = (
        cells.join(row_totals, rows)
        .join(column_totals, columns)
        .agg(F.sum("n_rows").alias("n"), F.sum(o * o / (F.col("r") * F.col("k"))).alias("share"))
    )
    by_row = row_totals.agg(F.count(F.lit(1)).alias("levels"), F.sum(1 / F.col("r")).alias("inverse"))
    by_column = column_totals.agg(F.count(F.lit(1)).alias("levels"), F.sum(1 / F.col("k")).alias("inverse"))
    joined = cell_sums.select(
        "n",
        (F.col("n") * (F.col("share") - 1)).alias("plain"),
        by_row.select(F.struct("levels", "inverse")).scalar().alias("rows"),
        by_column.select(F.struct("levels", "inverse")).scalar().alias("columns"),
    )
    dof = (F.col("rows.levels") - 1) * (F.col("columns.levels") - 1)
    # in a 2x2 table every cell is off its expectation by the same amount
    inverse_expected = F.col("n") * F.col("rows.inverse") * F.col("columns.inverse")
    off = F.sqrt(F.greatest(F.col("plain"), F.lit(0.0)) / inverse_expected)
    corrected = (off - F.least(off, F.lit(0.5))) ** 2 * inverse_expected
    return joined.select("n", F.when(dof == 1, corrected).otherwise(F.col("plain")).alias("chi2"), dof.alias("dof"))


def chi_square(df: DataFrame, rows: str, columns: str) -> DataFrame:
    stat = chi_square_statistic(df, rows, columns)
    p = F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_p(F.col("chi2"), F.col("dof").cast("double")))
    return stat.withColumn("p_value", p).select("*", significant())


# analysis of variance ---------------------------------------------------------


def anova_statistic(source: DataFrame | Sums, value: str, group: str) -> DataFrame:
    """One row: number of groups, rows, F and its degrees of freedom; ``error`` under two groups."""
    groups = joint(source, [value], by=[group]).where(F.col(group).isNotNull())
    groups = groups.select(F.col("n").cast("double").alias("n"), F.col(mean_of(value)).alias("mean"), F.col(m2_of(value)).alias("m2"))
    grand = groups.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")).scalar()
    between = F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2)
    sums = groups.withColumn("grand", grand).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum("n").alias("n"),
        between.alias("between"),
        F.sum("m2").alias("within"),
    )
    d1, d2 = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    enough = F.col("n_groups") >= 2
    return sums.select(
        "n_groups",
        F.coalesce(F.col("n"), F.lit(0.0)).cast("bigint").alias("n"),
        F.when(enough, ratio(F.col("between") / F.nullif(d1.cast("double"), F.lit(0.0)), ratio(F.col("within"), d2))).alias("f_statistic"),
        F.when(enough, d1).cast("double").alias("dof_between"),
        F.when(enough, d2).cast("double").alias("dof_within"),
        F.when(~enough, F.lit("at least two groups are needed")).alias("error"),
    )


def anova(source: DataFrame | Sums, value: str, group: str) -> DataFrame:
    stat = anova_statistic(source, value, group)
    p = f_p(F.col("f_statistic"), F.col("dof_between"), F.col("dof_within"))
    return stat.withColumn("p_value", p).select("*", significant())


# two groups --------------------------------------------------------------------


def channel_label(column: str, a: str, b: str) -> Column:
    """Group label "a" or "b" by a case-blind match; null for other rows."""
    upper = F.upper(F.col(column))
    return F.when(upper == a.upper(), "a").when(upper == b.upper(), "b")


def flag_label(column: str) -> Column:
    return F.when(F.col(column), "a").when(~F.col(column), "b")


def two_groups(source: DataFrame | Sums, value: str, label: Column) -> DataFrame | Sums:
    """Rows, or statistics, of the groups "a" and "b" that ``label`` gives, as ``grp``, without null amounts."""
    if isinstance(source, Sums):
        return source.labelled("grp", label).where(F.col("grp").isNotNull())
    return source.select("*", label.alias("grp")).where(F.col("grp").isNotNull() & F.col(value).isNotNull())


def welch_statistic(groups: DataFrame | Sums, value: str) -> DataFrame:
    """One row: sizes, means, t and the Welch-Satterthwaite dof; ``error`` under two rows a group."""
    parts = []
    for g in ("a", "b"):
        of = lambda name: F.max(F.when(F.col("grp") == g, F.col(name)))  # noqa: B023, E731
        n = F.coalesce(of("n"), F.lit(0))
        parts += [n.alias(f"n_{g}"), of(mean_of(value)).alias(f"mean_{g}"), ratio(of(m2_of(value)), n - 1).alias(f"var_{g}")]
    sums = joint(groups, [value], by=["grp"]).agg(*parts)
    ea, eb = ratio(F.col("var_a"), F.col("n_a")), ratio(F.col("var_b"), F.col("n_b"))
    dof = ratio((ea + eb) ** 2, ea**2 / (F.col("n_a") - 1) + eb**2 / (F.col("n_b") - 1))
    enough = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    return sums.select(
        "n_a",
        "n_b",
        "mean_a",
        "mean_b",
        F.when(enough, ratio(F.col("mean_a") - F.col("mean_b"), F.sqrt(ea + eb))).alias("statistic"),
        F.when(enough, dof).alias("dof"),
        F.when(~enough, F.lit("not enough rows")).alias("error"),
    )


def welch_t(groups: DataFrame | Sums, value: str) -> DataFrame:
    return welch_statistic(groups, value).withColumn("p_value", t_p(F.col("statistic"), F.col("dof")))


def _rank_counts(df: DataFrame, value: str, labels: Mapping[str, Column]) -> DataFrame:
    """Counts of the distinct values, for all the comparisons in ``labels`` at once, with running counts of each.

    A comparison's columns are ``{name}_a`` (rows in group a), ``{name}_n`` (in a or b) and ``{name}_cum``.
    """
    extra = {}
    for name, label in labels.items():
        extra[f"{name}_a"] = F.coalesce((label == "a").cast("bigint"), F.lit(0))
        extra[f"{name}_n"] = label.isNotNull().cast("bigint")
    return cumulative_counts(value_counts(df, [value], extra=extra), sums={f"{name}_cum": f"{name}_n" for name in labels})


def _rank_sum(ranked: DataFrame, name: str) -> DataFrame:
    """One row: sizes, U of group a and the tie sum of one comparison."""
    n, a = F.col(f"{name}_n").cast("double"), F.col(f"{name}_a").cast("double")
    sums = ranked.where(F.col(f"{name}_n") > 0).agg(
        F.coalesce(F.sum(f"{name}_a"), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum(F.col(f"{name}_n") - F.col(f"{name}_a")), F.lit(0)).alias("n_b"),
        F.sum(a * (F.col(f"{name}_cum") - (n - 1) / 2.0)).alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )
    enough = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    na = F.col("n_a").cast("double")
    return sums.select(
        "n_a",
        "n_b",
        F.when(enough, F.col("rank_sum") - na * (na + 1) / 2.0).alias("statistic"),
        F.when(enough, F.col("ties")).alias("ties"),
        F.when(~enough, F.lit("not enough rows")).alias("error"),
    )


def mann_whitney_statistic(groups: DataFrame, value: str) -> DataFrame:
    """One row: sizes, U of group a, and the tie sum, from counts per distinct value."""
    return _rank_sum(_rank_counts(groups, value, {"g": F.col("grp")}), "g")


def mann_whitney(groups: DataFrame, value: str) -> DataFrame:
    """Two-sided p: normal with tie and continuity corrections, exact for a small untied group."""
    return _rank_sum_test(mann_whitney_statistic(groups, value))


def _rank_sum_test(stat: DataFrame) -> DataFrame:
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    total = na + nb
    larger = F.greatest(F.col("statistic"), na * nb - F.col("statistic"))
    spread = F.sqrt(na * nb / 12.0 * ((total + 1) - ratio(F.col("ties"), total * (total - 1))))
    z = ratio(larger - na * nb / 2.0 - 0.5, spread)
    exact = (F.least(na, nb) <= EXACT_GROUP) & (F.col("ties") == 0)
    return (
        stat.withColumn("exact", exact)
        .withColumn("z", z)
        .withColumn("exact_tail", rank_sum_exact_p(F.when(F.col("exact"), larger), na, nb))
        .withColumn("normal_tail", normal_p("z"))
        .withColumn("p_value", F.least(F.lit(1.0), 2 * F.coalesce("exact_tail", "normal_tail")))
        .drop("exact", "exact_tail", "normal_tail")
    )


def compare_many(
    df: DataFrame, value: str, labels: Mapping[str, Column], keys: Sequence[Column | str], seed: int = DEFAULT_SEED, sums: Sums | None = None
) -> dict[str, DataFrame]:
    """For each label: Welch t if a seeded sample of both groups passes Shapiro-Wilk, else Mann-Whitney.

    All comparisons share the passes: one draws every sample, one counts the values for every rank sum, and
    ``sums`` gives the means without another. The normality results, two rows a comparison, decide on the
    driver which tests are planned.
    """
    rows = df.where(F.col(value).isNotNull())
    named = [F.when(label.isNotNull(), F.concat(F.lit(f"{name}:"), label)) for name, label in labels.items()]
    long = rows.select(row_hash(keys, seed).alias("_hash"), value, F.explode(F.array_compact(F.array(*named))).alias("_group"))
    groups = [f"{name}:{g}" for name in labels for g in ("a", "b")]
    sample = sample_rows(long, MAX_SAMPLE, (), seed, label="_group", labels=groups, ties=[value])
    passed = assess_normality(sample.select(F.col("_group").alias("variable"), F.col(value).cast("double").alias("value")))
    normal = Counter(r["variable"].split(":")[0] for r in passed.where(F.col("shapiro_p") > LEVEL).select("variable").collect())
    ranked_labels = {name: label for name, label in labels.items() if normal[name] < 2}
    ranked = _rank_counts(rows, value, ranked_labels) if ranked_labels else None
    found = {}
    for name, label in labels.items():
        split = two_groups(sums or rows, value, label)
        mean = welch_statistic(split, value).select(F.struct("mean_a", "mean_b").alias("m")).scalar()
        tested = _rank_sum_test(_rank_sum(ranked, name)) if name in ranked_labels else welch_t(split, value)
        found[name] = tested.select(
            F.lit("Mann-Whitney U" if name in ranked_labels else "Welch t-test").alias("test"),
            "statistic",
            "p_value",
            mean["mean_a"].alias("mean_a"),
            mean["mean_b"].alias("mean_b"),
            significant(),
            "error",
        )
    return found


def compare_groups(
    df: DataFrame, value: str, label: Column, keys: Sequence[Column | str], seed: int = DEFAULT_SEED, sums: Sums | None = None
) -> DataFrame:
    """One comparison of :func:`compare_many`."""
    return compare_many(df, value, {"g": label}, keys, seed, sums)["g"]


# regression and correlation ------------------------------------------------------


def volume_column(df: DataFrame) -> str:
    return "items_por_boleta" if "items_por_boleta" in df.columns else "unidades"


def simple_regression_statistic(source: DataFrame | Sums, y: str, x: str) -> DataFrame:
    """One row: n, slope, intercept, r2 and t of y on x; ``error`` for few rows or a constant y."""
    both = [y, x]
    sums = joint(source, both).select(
        "n",
        F.col(mean_of(x)).alias("mx"),
        F.col(mean_of(y)).alias("my"),
        F.col(m2_of(x)).alias("vx"),
        F.col(m2_of(y)).alias("vy"),
        cross_of(both, x, y).alias("cxy"),
        (F.col(f"min_{y}") < F.col(f"max_{y}")).alias("varies"),
    )
    usable = (F.col("n") >= MIN_REGRESSION_ROWS) & F.coalesce("varies", F.lit(False))
    slope = ratio(F.col("cxy"), F.col("vx"))
    r = ratio(F.col("cxy"), F.sqrt(F.col("vx")) * F.sqrt(F.col("vy")))
    return sums.select(
        "n",
        F.when(usable, slope).alias("slope"),
        F.when(usable, F.col("my") - slope * F.col("mx")).alias("intercept"),
        F.when(usable, r * r).alias("r_squared"),
        F.when(usable, r_to_t(r, F.col("n").cast("double"))).alias("t"),
        F.when(~usable, F.lit("not enough rows or no variance")).alias("error"),
    )


def simple_regression(source: DataFrame | Sums, y: str, x: str) -> DataFrame:
    stat = simple_regression_statistic(source, y, x)
    return stat.withColumn("p_value", t_p(F.col("t"), F.col("n").cast("double") - 2)).select("*", significant())


def correlation_test(source: DataFrame | Sums, a: str, b: str) -> DataFrame:
    """One row: n, r and its two-sided p."""
    r = pearson(source, [a, b]).where((F.col("column_a") == a) & (F.col("column_b") == b)).select("n", "r")
    n = F.col("n").cast("double")
    return r.withColumn("p_value", t_p(r_to_t(F.col("r"), n), n - 2)).select("*", significant())


# battery -----------------------------------------------------------------------


def _result(df: DataFrame, hypothesis: str, test: Column, statistic: str, **details: str) -> DataFrame:
    names = list(details)
    has_error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    detail = (
        F.map_from_arrays(F.array(*[F.lit(k) for k in names]), F.array(*[F.col(details[k]).cast("double") for k in names]))
        if names
        else F.lit(None).cast("map<string,double>")
    )
    return df.select(
        F.lit(hypothesis).alias("hypothesis"),
        test.alias("test"),
        F.col(statistic).cast("double").alias("statistic"),
        F.col("p_value").cast("double").alias("p_value"),
        "significant",
        detail.alias("details"),
        has_error.alias("error"),
    )


def _absent(df: DataFrame, hypothesis: str, *columns: str) -> DataFrame:
    """The row of a hypothesis whose columns are not in the table."""
    missing = ", ".join(c for c in columns if c not in df.columns)
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return df.sparkSession.range(1).select(
        F.lit(hypothesis).alias("hypothesis"), null("string", "test"), null("double", "statistic"), null("double", "p_value"),
        null("boolean", "significant"), null("map<string,double>", "details"), F.lit(f"missing column: {missing}").alias("error"),
    )


def battery_sums(df: DataFrame) -> Sums:
    """The statistics that the battery reads, of whatever columns the table has, written once."""
    numbers = [c for c in ("monto_aplicado", "porcentaje_descuento", volume_column(df), "edad") if c in df.columns]
    return collect_sums(df, numbers, paired=numbers, by=[c for c in BATTERY_KEYS if c in df.columns]).written()


def hypothesis_battery(df: DataFrame, keys: Sequence[Column | str], seed: int = DEFAULT_SEED, sums: Sums | None = None) -> DataFrame:
    """The five hypotheses on a prepared sales table, one row each; an error row where a column is absent.

    ``sums`` may hold the table's statistics, with the keys of ``BATTERY_KEYS``; the samples and the ranks
    then are all that reads the lines.
    """
    volume, amount = volume_column(df), "monto_aplicado"
    sums = sums or battery_sums(df)
    labels = {}
    if "canal" in df.columns:
        labels["channel"] = channel_label("canal", "APP", "WEB")
    if "es_fin_de_semana" in df.columns:
        labels["weekend"] = flag_label("es_fin_de_semana")
    compared = compare_many(df, amount, labels, keys, seed, sums) if labels else {}
    # hypothesis, the columns it needs, its test, statistic and details
    plans = [
        (("canal",), lambda: (compared["channel"], F.col("test"), "statistic", {"mean_a": "mean_a", "mean_b": "mean_b"})),
        (
            ("porcentaje_descuento", volume),
            lambda: (simple_regression(sums, volume, "porcentaje_descuento"), F.lit("linear regression"), "slope", {"r_squared": "r_squared"}),
        ),
        (("es_fin_de_semana",), lambda: (compared["weekend"], F.col("test"), "statistic", {"mean_finde": "mean_a", "mean_semana": "mean_b"})),
        (("edad",), lambda: (correlation_test(sums, "edad", amount), F.lit("Pearson"), "r", {})),
        (("genero",), lambda: (anova(sums, amount, "genero"), F.lit("ANOVA"), "f_statistic", {})),
    ]
    rows = []
    for name, (needed, plan) in zip(HYPOTHESES, plans):
        if all(c in df.columns for c in needed):
            found, test, statistic, details = plan()
            rows.append(_result(found, name, test, statistic, **details))
        else:
            rows.append(_absent(df, name, *needed))
    return functools.reduce(DataFrame.unionByName, rows)
