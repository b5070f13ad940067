"""Shapiro-Wilk and Kolmogorov-Smirnov tests on a bounded, seeded sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.distributions import ks_p, normal_p, normal_quantile
from tillmark.functions.expressions import polynomial, ratio
from tillmark.operators.sampling import DEFAULT_SEED, row_hash, sample_rows

MAX_SAMPLE = 5000

# Coefficients published by Royston (1995), algorithm AS R94, constant term first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)
SMALL_BOUND = (-2.273, 0.459)


def sample_values(
    df: DataFrame, columns: Sequence[str], keys: Sequence[Column | str], n: int = MAX_SAMPLE, seed: int = DEFAULT_SEED
) -> DataFrame:
    """At most ``n`` non-null values of each column, as ``(variable, value)``."""
    wide = df.select(row_hash(keys, seed).alias("_hash"), *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot(["_hash"], list(columns), "variable", "value").where(F.col("value").isNotNull())
    return sample_rows(long, n, (), seed, label="variable", labels=columns, ties=["value"]).select("variable", "value")


def _shapiro_p(w: Column, n: Column) -> Column:
    log_n, x = F.log(n), F.log(1 - w)
    bound = polynomial(SMALL_BOUND, n)
    small_z = (-F.log(bound - x) - polynomial(SMALL_MEAN, n)) / F.exp(polynomial(SMALL_LOG_SD, n))
    large_z = (x - polynomial(LARGE_MEAN, log_n)) / F.exp(polynomial(LARGE_LOG_SD, log_n))
    three = F.greatest(F.lit(0.0), F.lit(1.90985931710274) * (F.asin(F.sqrt(w)) - F.lit(1.04719755119660)))
    z = F.when(n <= 11, F.when(x < bound, small_z)).otherwise(large_z)
    return F.when(n == 3, three).when((n <= 11) & (x >= bound), F.lit(1e-99)).otherwise(normal_p(z))


def assess_normality(sample: DataFrame) -> DataFrame:
    """Both tests for each variable of a ``(variable, value)`` sample.

    A window here covers one sample of bounded size. A constant sample gives null results.
    """
    every = W.partitionBy("variable")
    ordered = sample.select(
        "variable",
        "value",
        F.row_number().over(every.orderBy("value")).alias("i"),
        F.count(F.lit(1)).over(every).cast("double").alias("n"),
        F.avg("value").over(every).alias("mean"),
        F.stddev_samp("value").over(every).alias("std"),
    )
    scored = ordered.withColumns(
        {
            "x": F.col("value") - F.col("mean"),
            "m": normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)),
            "cdf": normal_p(-ratio(F.col("value") - F.col("mean"), F.col("std"))),
        }
    )
    at = lambda name, place: F.max(F.when(F.col("i") == place, F.col(name)))
    sums = scored.groupBy("variable", "n").agg(
        F.sum(F.col("x") * F.col("x")).alias("ss"),
        F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum(F.col("m") * F.col("x")).alias("mx"),
        at("m", F.col("n")).alias("m_last"),
        at("m", F.col("n") - 1).alias("m_next"),
        at("x", F.col("n")).alias("x_last"),
        at("x", F.col("n") - 1).alias("x_next"),
        at("x", F.lit(1)).alias("x_first"),
        at("x", F.lit(2)).alias("x_second"),
        F.max(F.greatest(F.col("i") / F.col("n") - F.col("cdf"), F.col("cdf") - (F.col("i") - 1) / F.col("n"))).alias("d"),
    )
    n = F.col("n")
    root = 1 / F.sqrt(n)
    last = polynomial(LAST_WEIGHT, root) + F.col("m_last") / F.sqrt("mm")
    following = polynomial(NEXT_WEIGHT, root) + F.col("m_next") / F.sqrt("mm")
    weighted = sums.withColumns(
        {
            "a_last": F.when(n == 3, F.lit(0.5).cast("double") ** 0.5).otherwise(last),
            "a_next": F.when(n > 5, following),
        }
    )
    two = F.col("a_next").isNotNull()
    outer_m = 2 * F.col("m_last") ** 2 + F.when(two, 2 * F.col("m_next") ** 2).otherwise(0.0)
    outer_a = 2 * F.col("a_last") ** 2 + F.when(two, 2 * F.col("a_next") ** 2).otherwise(0.0)
    inner_scale = F.sqrt(ratio(F.col("mm") - outer_m, 1 - outer_a))
    range_last, range_next = F.col("x_last") - F.col("x_first"), F.col("x_next") - F.col("x_second")
    inner_mx = F.col("mx") - F.col("m_last") * range_last - F.when(two, F.col("m_next") * range_next).otherwise(0.0)
    b = (
        F.col("a_last") * range_last
        + F.when(two, F.col("a_next") * range_next).otherwise(0.0)
        + F.when(n > 3, ratio(inner_mx, inner_scale)).otherwise(0.0)
    )
    w = F.when((n >= 3) & (F.col("ss") > 0), F.least(F.lit(1.0), ratio(b * b, F.col("ss"))))
    return weighted.select("variable", n.cast("bigint").alias("n"), w.alias("shapiro_w"), "d", (F.col("ss") > 0).alias("varies")).select(
        "variable",
        "n",
        "shapiro_w",
        _shapiro_p(F.col("shapiro_w"), F.col("n").cast("double")).alias("shapiro_p"),
        F.when(F.col("varies"), F.col("d")).alias("ks_d"),
        ks_p(F.when(F.col("varies"), F.col("d")), F.col("n").cast("double")).alias("ks_p"),
    )




def normality_tests(
    df: DataFrame, columns: Sequence[str], keys: Sequence[Column | str], n: int = MAX_SAMPLE, seed: int = DEFAULT_SEED
) -> DataFrame:
    return assess_normality(sample_values(df, columns, keys, n, seed))


def correlation_method(normality: DataFrame, columns: Sequence[str], level: float = 0.05) -> str:
    """"pearson" if every column passes Shapiro-Wilk, else "spearman"; a null p-value does not pass."""
    passed = normality.agg(F.count_if(F.col("shapiro_p") > level).alias("n")).first()["n"]
    return "pearson" if columns and passed == len(columns) else "spearman"
