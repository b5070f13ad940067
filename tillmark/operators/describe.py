"""Descriptive statistics and simple group summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.expressions import half_even, ratio
from tillmark.operators.quantiles import quantiles
from tillmark.operators.sums import Sums, univariate
from tillmark.schema import numeric_columns


def moments(source: DataFrame | Sums, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, corrected skewness and kurtosis, one row per column.

    A constant column has skewness and kurtosis 0; both are null for too few values, and all but the count are for none.
    """
    n, varies = F.col("count").cast("double"), F.col("min") < F.col("max")
    variance = F.col("m2") / n
    skewness = F.col("m3") / n / (variance * F.sqrt(variance)) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    excess = F.col("m4") / n / (variance * variance) - 3
    kurtosis = ratio(n - 1, (n - 2) * (n - 3)) * ((n + 1) * excess + 6)
    return univariate(source, columns).select(
        "variable",
        "count",
        "mean",
        F.when(varies, F.sqrt(ratio(F.col("m2"), n - 1))).when(n > 1, 0.0).alias("std"),
        "min",
        "max",
        F.when(n >= 3, F.when(varies, skewness).otherwise(0.0)).alias("skewness"),
        F.when(n >= 4, F.when(varies, kurtosis).otherwise(0.0)).alias("kurtosis"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4, sums: Sums | None = None) -> DataFrame:
    """Count, mean, deviation, extremes, quartiles, skewness and kurtosis, one row per column, empty ones included.

    ``sums`` may hold the statistics of ``df`` already; then only the quartiles read it.
    """
    columns = list(columns or numeric_columns(df))
    quarters = quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    names = ["mean", "std", "min", "p25", "p50", "p75", "max", "skewness", "kurtosis"]
    return moments(sums or df, columns).join(quarters, "variable", "left").select(
        "variable", "count", *[half_even(F.col(c), digits).alias(c) for c in names]
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count of each non-null value and its percent of all rows, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    share = half_even(ratio(F.col("n_rows"), total) * 100, 2)
    return counts.where(F.col(column).isNotNull()).select(column, "n_rows", share.alias("pct")).orderBy(F.desc("n_rows"), column)


def hourly_sales(df: DataFrame) -> DataFrame:
    """Total amount for each of the 24 hours, zero where nothing was sold."""
    sold = df.groupBy("hora").agg(F.sum("monto_aplicado").alias("sold"))
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hora"))
    return hours.join(sold, "hora", "left").select("hora", F.coalesce("sold", F.lit(0.0)).alias("monto"))


def peak_hours(df: DataFrame) -> DataFrame:
    """Hours with the highest and lowest total among hours with sales, the earlier hour on ties."""
    sold = df.where(F.col("hora").isNotNull()).groupBy("hora").agg(F.sum("monto_aplicado").alias("sold"))
    return sold.agg(
        F.min_by("hora", F.struct(-F.col("sold"), F.col("hora"))).alias("hora_mayor_venta"),
        F.min_by("hora", F.struct(F.col("sold"), F.col("hora"))).alias("hora_menor_venta"),
    )


def contingency(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of each pair of values that occurs; null keys are left out."""
    return (
        df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(rows, columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def contingency_wide(df: DataFrame, rows: str, columns: str, levels: Sequence[str]) -> DataFrame:
    """The same counts with one column per given level and zero for an empty cell."""
    counts = contingency(df, rows, columns)
    return counts.groupBy(rows).pivot(columns, list(levels)).agg(F.sum("n_rows")).fillna(0, list(levels))


def shop_totals(df: DataFrame, shop: str = "local") -> DataFrame:
    """Rows and amount per shop, and a last row with the grand total; rows without a shop are left out.

    The grand total is rolled up from the shop rows, so the sales lines are read and shuffled once.
    """
    shops = (
        df.where(F.col(shop).isNotNull())
        .groupBy(shop)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("monto_aplicado").alias("monto"))
    )
    return shops.rollup(shop).agg(
        F.grouping(shop).cast("int").alias("is_total"),
        F.sum("n").alias("n_rows"),
        F.sum("monto").alias("sum_monto"),
    )


def merge_partial_maps(partials: DataFrame, map_column: str) -> DataFrame:
    """Add up maps of partial numbers key by key: ``(key, total)``."""
    return partials.select(F.explode(map_column).alias("key", "value")).groupBy("key").agg(F.sum("value").alias("total"))


def partial_maps(df: DataFrame, key: str, entry: str, value: str) -> DataFrame:
    """Per ``key``, a map from each value of ``entry`` to the sum of ``value``."""
    sums = df.where(F.col(key).isNotNull() & F.col(entry).isNotNull()).groupBy(key, entry).agg(F.sum(value).alias("total"))
    return sums.select(key, F.create_map(entry, "total").alias("parts"))
