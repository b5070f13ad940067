"""Outlier flags by interquartile range and by z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.expressions import half_even, ratio
from tillmark.operators.quantiles import quantiles
from tillmark.operators.sums import Sums, univariate

QUARTILES = {"q1": 0.25, "q3": 0.75}


def iqr_limits(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """``(variable, lower, upper)``; values strictly outside are outliers."""
    spread = F.col("q3") - F.col("q1")
    return quantiles(df, columns, QUARTILES).select(
        "variable", (F.col("q1") - factor * spread).alias("lower"), (F.col("q3") + factor * spread).alias("upper")
    )


def _limits(df: DataFrame, column: str, factor: float) -> Column:
    return iqr_limits(df, [column], factor).agg(F.struct(F.max("lower").alias("lower"), F.max("upper").alias("upper")).alias("l")).scalar()


def _moments(source: DataFrame | Sums, column: str) -> Column:
    found = univariate(source, [column])
    return found.select(F.struct("mean", F.sqrt(ratio(F.col("m2"), F.col("count"))).alias("std"))).scalar()


def flag_outliers(df: DataFrame, column: str, factor: float = 1.5, threshold: float = 3.0, sums: Sums | None = None) -> DataFrame:
    """Add boolean columns ``iqr_outlier`` and ``zscore_outlier``; a null value is no outlier."""
    limits, moments, x = _limits(df, column, factor), _moments(sums or df, column), F.col(column)
    outside = (x < limits["lower"]) | (x > limits["upper"])
    score = F.abs(ratio(x - moments["mean"], moments["std"]))
    return df.withColumns(
        {
            "iqr_outlier": F.coalesce(outside, F.lit(False)),
            "zscore_outlier": F.coalesce(score > threshold, F.lit(False)),
        }
    )


def outlier_summary(df: DataFrame, column: str, factor: float = 1.5, threshold: float = 3.0, sums: Sums | None = None) -> DataFrame:
    """One row: counts and percents of both kinds of outlier among the non-null values."""
    if column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(column).alias("column"), F.lit("column not found").alias("error"))
    flagged = flag_outliers(df.select(column).where(F.col(column).isNotNull()), column, factor, threshold, sums)
    parts = []
    for kind in ("iqr", "zscore"):
        n = F.count_if(F.col(f"{kind}_outlier"))
        parts += [
            n.alias(f"n_{kind}_outliers"),
            half_even(ratio(n, F.count(F.lit(1))) * 100, 2).alias(f"pct_{kind}_outliers"),
        ]
    return flagged.agg(*parts).select(F.lit(column).alias("column"), "*")
