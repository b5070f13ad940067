"""Tables behind the charts: histograms, density curves and box statistics.

Values are binned where they are read; only bins are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.expressions import ratio
from tillmark.operators.quantiles import long_values, quantiles

GRID_POINTS = 200
WHISKER = 1.5
#: Cells that a density curve sums values in before the kernel. A value moves by less than a cell's width w, to the
#: mean of its cell, which changes the kernel by less than (w / bandwidth)^2 / 8 of its height.
DENSITY_CELLS = 16_384


def _shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with values: n, extremes and deviation."""
    value = F.col("value")
    found = long_values(df, columns).groupBy("variable").agg(
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.stddev_samp(value).alias("std")
    )
    return found.where(F.col("n") > 0)


def bin_plan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: n, extremes, number of bins and width.

    The width is Sturges' or, if smaller, Freedman-Diaconis' (held to at most 2 sqrt(n) bins).
    """
    extremes = _shape(df, columns).drop("std")
    quarters = quantiles(df, columns, {"q1": 0.25, "q3": 0.75}).drop("n")
    spread, n = F.col("high") - F.col("low"), F.col("n").cast("double")
    diaconis = F.greatest(2.0 * (F.col("q3") - F.col("q1")) / F.pow(n, F.lit(1 / 3)), spread / F.sqrt(n) / 2.0)
    width = F.least(diaconis, spread / (F.log2(n) + 1.0))
    bins = F.when(spread > 0, F.ceil(ratio(spread, width))).otherwise(F.lit(1)).cast("bigint")
    margin = F.when(spread > 0, 0.0).otherwise(0.5)
    return (
        extremes.join(quarters, "variable")
        .withColumn("bins", bins)
        .withColumns({"low": F.col("low") - margin, "high": F.col("high") + margin})
        .withColumn("width", (F.col("high") - F.col("low")) / F.col("bins"))
        .select("variable", "n", "low", "high", "bins", "width")
    )


def histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, bin, left, right, n_rows, density)`` for bins that hold values."""
    plan = F.broadcast(bin_plan(df, columns).withColumnRenamed("n", "rows"))  # one row per column
    place = F.floor((F.col("value") - F.col("low")) / F.col("width"))
    values = long_values(df, columns).where(F.col("value").isNotNull())
    binned = values.join(plan, "variable").withColumn("bin", F.least(place, F.col("bins") - 1))
    totals = binned.groupBy("variable", "bin", "low", "width", "rows").agg(F.count(F.lit(1)).alias("n_rows"))
    return totals.select(
        "variable",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("left"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("right"),
        "n_rows",
        (F.col("n_rows") / (F.col("rows") * F.col("width"))).alias("density"),
    )


def density_curve(df: DataFrame, columns: Sequence[str], points: int = GRID_POINTS, cells: int = DENSITY_CELLS) -> DataFrame:
    """Gaussian kernel density, Scott bandwidth, on an even grid over the range of each column.

    Values are first summed in ``cells`` even cells, one pass that is combined map-side; each cell then
    counts as its mean value. A constant column has no curve.
    """
    n = F.col("rows").cast("double")
    shape = _shape(df, columns).withColumnRenamed("n", "rows").where(F.col("std") > 0)
    shape = shape.withColumn("bandwidth", F.col("std") * F.pow(n, F.lit(-0.2)))
    plan = F.broadcast(shape)  # one row per column
    cell = F.least(F.floor((F.col("value") - F.col("low")) / ((F.col("high") - F.col("low")) / float(cells))), F.lit(cells - 1))
    values = long_values(df, columns).where(F.col("value").isNotNull()).join(plan, "variable")
    summed = values.groupBy("variable", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    at = F.col("low") + F.col("point") * (F.col("high") - F.col("low")) / (points - 1.0)
    spread = summed.join(plan, "variable").select("*", steps).withColumn("x", at)
    z = (F.col("x") - F.col("value")) / F.col("bandwidth")
    sums = spread.groupBy("variable", "point").agg(
        F.max("x").alias("x"), F.sum(F.col("n") * F.exp(-z * z / 2.0)).alias("total"), F.max(n * F.col("bandwidth")).alias("scale")
    )
    return sums.select("variable", "point", "x", (F.col("total") / F.col("scale") / math.sqrt(2 * math.pi)).alias("density"))


def box_statistics(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``value`` per ``group``."""
    quarters = quantiles(df, [value], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[group])
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    fenced = quarters.select(
        group, F.col("n").alias("rows"), "q1", "median", "q3", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )
    x = F.col("value")
    inside = (x >= F.col("low")) & (x <= F.col("high"))
    return (
        df.select(group, F.col(value).cast("double").alias("value"))
        .where(F.col("value").isNotNull())
        .join(fenced, group)
        .groupBy(group, "rows", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("lowest"),
            F.max(F.when(inside, x)).alias("highest"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .select(
            group,
            F.col("rows").alias("n_rows"),
            "q1",
            "median",
            "q3",
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "n_outliers",
        )
    )
