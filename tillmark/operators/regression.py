"""Linear regression of the amount with its coefficient table, fit measures and diagnostics.

The design is a categorical channel and three numeric columns, so a grouped aggregate with one
row per channel holds every cross product the fit needs. Only those few rows reach the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.distributions import chi2_p, normal_quantile, t_critical, t_p
from tillmark.functions.expressions import ratio
from tillmark.operators.hypothesis import volume_column
from tillmark.operators.sampling import DEFAULT_SEED, hash_split, sample_rows, train_flag
from tillmark.operators.sums import Sums, joint

LABEL = "monto_aplicado"
PLOT_SAMPLE = 5000
#: Shares of a design's largest eigenvalue that count as nothing.
RANK_TOLERANCE = 1e-12
MIN_VIF_ROWS = 10


def _needed(df: DataFrame) -> list[str]:
    return [LABEL, "canal", "local", volume_column(df), "porcentaje_descuento"]


def train_rows(df: DataFrame, keys: Sequence[Column | str], seed: int = DEFAULT_SEED, ratio_train: float = 0.7) -> Column:
    """Whether a row trains the model; null if it lacks a model column."""
    complete = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _needed(df)])
    return F.when(complete, train_flag(keys, seed, ratio_train))


def model_rows(df: DataFrame, keys: Sequence[Column | str], seed: int = DEFAULT_SEED, ratio_train: float = 0.7) -> DataFrame:
    """Rows complete in the model columns, with ``is_train``."""
    needed = _needed(df)
    split = hash_split(df.dropna(subset=needed), keys, seed, ratio_train)
    return split.select(*dict.fromkeys([*needed, *[k for k in keys if isinstance(k, str)]]), "boleta", "sku", "is_train")


@dataclass
class Design:
    """Columns of the model: an intercept, a 0/1 column per channel but the first, numeric columns.

    Numeric columns and the label enter sums less their train means, which keeps digits.
    """

    levels: list[str]
    numeric: list[str]
    means: list[float]
    label_mean: float

    @property
    def terms(self) -> list[str]:
        return ["intercept", *[f"canal_{level}" for level in self.levels[1:]], *self.numeric]

    def cross_products(self, train: DataFrame, target: Column) -> tuple[np.ndarray, np.ndarray]:
        """Products of the design with itself and with ``target``, summed over the train rows."""
        x = [F.col(name) - mean for name, mean in zip(self.numeric, self.means)]
        parts = {"n": F.count(F.lit(1)).cast("double"), "y": F.sum(target)}
        for i, a in enumerate(x):
            parts[f"x{i}"], parts[f"xy{i}"] = F.sum(a), F.sum(a * target)
            for j in range(i, len(x)):
                parts[f"xx{i}_{j}"] = F.sum(a * x[j])
        rows = train.groupBy("canal").agg(*[c.alias(name) for name, c in parts.items()]).collect()  # one row per level
        k, p = len(self.levels), len(x)
        xtx, xty = np.zeros((k + p, k + p)), np.zeros(k + p)
        for row in rows:
            dummies = np.zeros(k)
            dummies[[0, self.levels.index(row["canal"])]] = 1.0
            xtx[:k, :k] += row["n"] * np.outer(dummies, dummies)
            xtx[:k, k:] += np.outer(dummies, [row[f"x{i}"] for i in range(p)])
            xtx[k:, k:] += [[row[f"xx{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)]
            xty += np.concatenate([dummies * row["y"], [row[f"xy{i}"] for i in range(p)]])
        xtx[k:, :k] = xtx[:k, k:].T
        return xtx, xty


@dataclass
class AmountModel:
    """Least-squares fit: coefficients and their covariance in the order of ``design.terms``."""

    design: Design
    coefficients: np.ndarray
    covariance: np.ndarray
    inverse: np.ndarray
    n_train: int
    rss: float
    rank: int

    @property
    def terms(self) -> list[str]:
        return self.design.terms

    @property
    def dof(self) -> int:
        return self.n_train - self.rank

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows with ``fitted`` and ``residual``; a channel unseen in training is an error."""
        return with_fitted(rows, self.design, self.coefficients)


def with_fitted(rows: DataFrame, design: Design, coefficients: np.ndarray) -> DataFrame:
    values = dict(zip(design.terms, coefficients.tolist()))
    effect = F.raise_error(F.lit("channel without train rows")).cast("double")
    for level in design.levels:
        effect = F.when(F.col("canal") == level, values.get(f"canal_{level}", 0.0)).otherwise(effect)
    fitted = values["intercept"] + effect
    for name in design.numeric:
        fitted = fitted + values[name] * F.col(name)
    return rows.withColumn("fitted", fitted).withColumn("residual", F.col(LABEL) - F.col("fitted"))


def fit_amount_model(rows: DataFrame) -> AmountModel:
    """Least squares of amount on channel, shop, volume and discount, on the train rows.

    The alphabetically first channel is the base level. Three passes: means, cross products,
    residual sum of squares. A singular design, such as a constant volume, takes the smallest coefficients,
    and its rank counts for the degrees of freedom.
    """
    train = rows.where("is_train")
    numeric = ["local", volume_column(rows), "porcentaje_descuento"]
    found = train.agg(
        F.array_sort(F.collect_set("canal")).alias("levels"), *[F.avg(c).alias(c) for c in (*numeric, LABEL)]
    ).first()
    design = Design(found["levels"], numeric, [found[c] for c in numeric], found[LABEL])
    xtx, xty = design.cross_products(train, F.col(LABEL) - design.label_mean)
    scale = np.sqrt(np.diag(xtx))
    scale[scale == 0] = 1.0
    scaled = xtx / np.outer(scale, scale)
    inverse = np.linalg.pinv(scaled, hermitian=True, rtol=RANK_TOLERANCE) / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(scaled)
    free = vectors[:, values <= RANK_TOLERANCE * values.max()] / scale[:, None]
    # back from deviations to the columns themselves: only the intercept changes
    back = np.eye(len(scale))
    back[0, len(design.levels) :] = -np.array(design.means)
    coefficients = back @ (inverse @ xty)
    coefficients[0] += design.label_mean
    # what the design leaves free is taken out of the coefficients, which makes them the smallest
    directions, _ = np.linalg.qr(back @ free)
    smallest = np.eye(len(scale)) - directions @ directions.T
    coefficients = smallest @ coefficients
    e = F.col("residual")
    n, rss = with_fitted(train, design, coefficients).agg(F.count(e), F.sum(e * e)).first()
    rank = len(scale) - free.shape[1]
    covariance = smallest @ back @ inverse @ back.T @ smallest * (rss / max(n - rank, 1))
    return AmountModel(design, coefficients, covariance, inverse, n, rss, rank)


def coefficient_table(model: AmountModel, spark: SparkSession) -> DataFrame:
    """One row per term: coefficient, standard error, t, p and the 95 % interval."""
    errors = np.sqrt(np.diag(model.covariance))
    rows = [
        (i, term, float(c), float(error), float(model.dof))
        for i, (term, c, error) in enumerate(zip(model.terms, model.coefficients, errors))
    ]
    table = spark.createDataFrame(rows, "position int, term string, coefficient double, std_error double, dof double")
    return (
        table.withColumn("t", ratio(F.col("coefficient"), F.col("std_error")))
        .withColumn("p_value", t_p("t", "dof"))
        .withColumn("width", t_critical(F.lit(0.975), F.col("dof")) * F.col("std_error"))
        .select(
            "position",
            "term",
            "coefficient",
            "std_error",
            "t",
            "p_value",
            (F.col("coefficient") - F.col("width")).alias("low"),
            (F.col("coefficient") + F.col("width")).alias("high"),
        )
    )


def fit_measures(model: AmountModel, rows: DataFrame) -> DataFrame:
    """One row: train size and adjusted R2, test size, RMSE and MAE, from one pass over all rows."""
    train, test = F.col("is_train"), ~F.col("is_train")
    e = F.col("residual")
    sums = model.predict(rows).agg(
        F.count_if(train).alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.sum(F.when(train, e * e)).alias("rss"),
        F.var_pop(F.when(train, F.col(LABEL))).alias("variance"),
        F.sqrt(F.avg(F.when(test, e * e))).alias("rmse_test"),
        F.avg(F.when(test, F.abs(e))).alias("mae_test"),
    )
    n = F.col("n_train").cast("double")
    unexplained = ratio(F.col("rss"), n * F.col("variance"))
    adjusted = 1 - unexplained * ratio(n - 1, n - model.rank)
    return sums.select("n_train", "n_test", adjusted.alias("r_squared_adj"), "rmse_test", "mae_test")


def breusch_pagan(model: AmountModel, rows: DataFrame) -> DataFrame:
    """One row: n R2 of the squared residuals on the same design, and its chi-square p."""
    train = model.predict(rows.where("is_train"))
    squared = F.col("residual") ** 2 - model.rss / model.n_train
    total = train.agg(F.sum(squared * squared)).first()[0]
    _, xty = model.design.cross_products(train, squared)
    explained = float(xty @ model.inverse @ xty)
    statistic = model.n_train * explained / total if total else None
    one = rows.sparkSession.range(1).select(
        F.lit(statistic).cast("double").alias("statistic"), F.lit(float(model.rank - 1)).alias("dof")
    )
    return one.withColumn("p_value", chi2_p("statistic", "dof")).withColumn("homocedastico", F.col("p_value") > 0.05)


def jarque_bera(residuals: DataFrame, column: str = "residual") -> DataFrame:
    """One row: statistic, p, population skewness and kurtosis (3 for a normal)."""
    sums = residuals.agg(
        F.count(column).cast("double").alias("n"),
        F.skewness(column).alias("skew"),
        (F.kurtosis(column) + 3).alias("kurtosis"),
    )
    statistic = F.col("n") / 6 * (F.col("skew") ** 2 + (F.col("kurtosis") - 3) ** 2 / 4)
    return sums.select(
        statistic.alias("statistic"), F.exp(-statistic / 2).alias("p_value"), "skew", "kurtosis"
    ).withColumn("residuales_normales", F.col("p_value") > 0.05)


def variance_inflation(source: DataFrame | Sums, columns: Sequence[str], intercept: bool = False) -> DataFrame:
    """Variance inflation of each column: ``(variable, vif)``, no rows under ten complete rows.

    The default regresses each column on the others without a constant (uncentred), from their cross
    products, one row of sums. A column that the others give exactly has an infinite factor, one
    without any value but zero has none.
    """
    columns = list(columns)
    sums = joint(source, columns).first()
    spark = source.table.sparkSession if isinstance(source, Sums) else source.sparkSession
    rows = []
    if sums["n"] >= MIN_VIF_ROWS:
        gram = np.zeros((len(columns), len(columns)))
        for i, a in enumerate(columns):
            for j, b in enumerate(columns[i:], i):
                centred = sums[f"m2_{a}" if i == j else f"cross_{a}_{b}"] / sums["n"]
                gram[i, j] = gram[j, i] = centred if intercept else centred + sums[f"mean_{a}"] * sums[f"mean_{b}"]
        scale = np.sqrt(np.diag(gram))
        unit = gram / np.outer(np.where(scale > 0, scale, 1.0), np.where(scale > 0, scale, 1.0))
        for i, name in enumerate(columns):
            others = [j for j in range(len(columns)) if j != i]
            known = unit[i, others] @ np.linalg.pinv(unit[np.ix_(others, others)], hermitian=True, rtol=RANK_TOLERANCE) @ unit[others, i]
            left = 1.0 - float(known)
            rows.append((name, None if scale[i] == 0 else float("inf") if left <= RANK_TOLERANCE else 1.0 / left))
    return spark.createDataFrame(rows, "variable string, vif double")


def residual_sample(
    model: AmountModel, rows: DataFrame, keys: Sequence[Column | str], n: int = PLOT_SAMPLE, seed: int = DEFAULT_SEED
) -> DataFrame:
    """``(fitted, residual)`` of a seeded sample of train rows."""
    scored = model.predict(rows.where("is_train"))
    return sample_rows(scored, n, keys, seed, ties=[LABEL, "residual"]).select("fitted", "residual")


def qq_points(sample: DataFrame, column: str = "residual") -> DataFrame:
    """Sample quantiles beside normal quantiles i / (n + 1), with the line through mean and deviation."""
    every = W.partitionBy()
    placed = sample.select(
        F.row_number().over(every.orderBy(column)).alias("i"),
        F.count(F.lit(1)).over(every).alias("n"),
        F.col(column).alias("sample_quantile"),
        F.avg(column).over(every).alias("mean"),
        F.stddev_pop(column).over(every).alias("std"),
    )
    theoretical = normal_quantile(F.col("i") / (F.col("n") + 1.0))
    return placed.withColumn("theoretical", theoretical).select(
        "i", "theoretical", "sample_quantile", (F.col("mean") + F.col("std") * F.col("theoretical")).alias("line")
    )
