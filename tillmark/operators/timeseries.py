"""Daily series, additive decomposition and autocorrelation.

Windows here run over days, not sales lines: a series holds one row per calendar day. Each
operator takes ``by`` columns, so one series per shop or channel is worked out in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.expressions import ratio

MAX_LAG = 40
Z_95 = 1.959963984540054


def daily_sales(df: DataFrame, by: Sequence[str] = (), value: str = "monto_aplicado") -> DataFrame:
    """``(by..., day, sales)`` for every day from the first to the last sale, zero on empty days."""
    days = df.where(F.col("fecha").isNotNull()).select(*by, F.to_date("fecha").alias("day"), value)
    for key in by:
        days = days.where(F.col(key).isNotNull())
    sold = days.groupBy(*by, "day").agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("sales"))
    span = sold.groupBy(*by).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = span.where(F.col("first").isNotNull()).select(*by, F.explode(F.sequence("first", "last")).alias("day"))
    return calendar.join(sold, [*by, "day"], "left").select(*by, "day", F.coalesce("sales", F.lit(0.0)).alias("sales"))


def daily_summary(series: DataFrame) -> DataFrame:
    """Mean, sample deviation and the day of the maximum, the first one on ties."""
    return series.agg(
        F.avg("sales").alias("mean"),
        F.stddev_samp("sales").alias("std"),
        F.min_by("day", F.struct(-F.col("sales"), F.col("day"))).alias("max_date"),
    )


def decompose(series: DataFrame, period: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Trend by a centred moving average, seasonal means summing to zero, and the rest.

    An even period gives its two end days half a weight. Series shorter than two periods
    return no rows.
    """
    key = W.partitionBy(*by)
    ordered = key.orderBy("day")
    half = period // 2
    around = ordered.rowsBetween(-half, half)
    if period % 2:
        average = F.avg("sales").over(around)
    else:
        ends = F.lag("sales", half).over(ordered) + F.lead("sales", half).over(ordered)
        average = (F.sum("sales").over(around) - ends / 2.0) / period
    full = F.count(F.lit(1)).over(around) == 2 * half + 1
    trended = (
        series.withColumn("i", F.row_number().over(ordered) - 1)
        .withColumn("n", F.count(F.lit(1)).over(key))
        .where(F.col("n") >= 2 * period)
        .withColumn("trend", F.when(full, average))
        .withColumn("phase", F.col("i") % period)
    )
    # without by columns the key needs a constant to join on
    keys = [*by, "_series"]
    trended = trended.withColumn("_series", F.lit(0))
    phases = trended.groupBy(*keys, "phase").agg(F.avg(F.col("sales") - F.col("trend")).alias("average"))
    levels = phases.withColumn("seasonal", F.col("average") - F.avg("average").over(W.partitionBy(*keys))).drop("average")
    return (
        trended.join(levels, [*keys, "phase"])
        .withColumn("residual", F.col("sales") - F.col("trend") - F.col("seasonal"))
        .select(*by, "day", "sales", "trend", "seasonal", "residual")
    )


def autocorrelation(series: DataFrame, max_lag: int = MAX_LAG, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., lag, acf, low, high)``: biased autocorrelation with its 95 % Bartlett interval."""
    key = W.partitionBy(*by)
    ordered = key.orderBy("day")
    centred = series.select(
        *by, "day", (F.col("sales") - F.avg("sales").over(key)).alias("x"), F.count(F.lit(1)).over(key).alias("n")
    )
    lagged = centred.select(*by, "n", "x", *[F.lag("x", k).over(ordered).alias(f"x{k}") for k in range(1, max_lag + 1)])
    products = [F.sum(F.col("x") * F.col("x"))] + [F.sum(F.col("x") * F.col(f"x{k}")) for k in range(1, max_lag + 1)]
    sums = lagged.groupBy(*by, "n").agg(F.array(*products).alias("c"))
    lags = sums.select(*by, "n", F.col("c")[0].alias("c0"), F.posexplode("c").alias("lag", "ck")).where(F.col("lag") < F.col("n"))
    acf = lags.select(*by, "n", "lag", ratio(F.col("ck"), F.col("c0")).alias("acf"))
    per_series = W.partitionBy(*by, "n").orderBy("lag")
    inner = F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)
    earlier = F.coalesce(F.sum(inner).over(per_series.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    half_width = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(Z_95 * F.sqrt((1 + 2 * earlier) / F.col("n")))
    return acf.select(
        *by, "n", "lag", "acf", (F.col("acf") - half_width).alias("low"), (F.col("acf") + half_width).alias("high")
    )


def _levinson(r: Column, lags: Column) -> Column:
    """Partial autocorrelations 1..lags from autocorrelations r (index 0 is lag 0)."""

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        known = F.transform(phi, lambda p, j: p * F.get(r, k - 1 - j))
        explained = F.aggregate(known, F.lit(0.0), lambda total, v: total + v)
        last = ratio(F.get(r, k) - explained, state["rest"])
        updated = F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b)
        return F.struct(
            F.concat(updated, F.array(last)).alias("phi"),
            (state["rest"] * (1 - last * last)).alias("rest"),
            F.concat(state["out"], F.array(last)).alias("out"),
        )

    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.lit(1.0).alias("rest"), empty.alias("out"))
    steps = F.when(lags >= 1, F.sequence(F.lit(1), F.greatest(lags, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step, lambda state: state["out"])


def partial_autocorrelation(series: DataFrame, max_lag: int = MAX_LAG, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., lag, pacf, low, high)`` by Yule-Walker, for lags under half the series length."""
    acf = autocorrelation(series, max_lag, by)
    arrays = acf.groupBy(*by, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("r"))
    usable = F.least(F.lit(max_lag), F.floor(F.col("n") / 2.0).cast("int") - 1)
    solved = arrays.select(*by, "n", F.concat(F.array(F.lit(1.0)), _levinson(F.col("r"), usable)).alias("p"))
    half_width = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(Z_95 / F.sqrt("n"))
    return solved.select(*by, "n", F.posexplode("p").alias("lag", "pacf")).select(
        *by, "n", "lag", "pacf", (F.col("pacf") - half_width).alias("low"), (F.col("pacf") + half_width).alias("high")
    )
