"""Correlation matrices in long form, with two-sided p-values."""

from __future__ import annotations

from itertools import combinations_with_replacement
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.distributions import t_p
from tillmark.functions.expressions import half_even, ratio
from tillmark.operators.quantiles import average_ranks
from tillmark.operators.sums import Sums, cross_of, joint, m2_of
from tillmark.session import materialize


def _both_triangles(upper: DataFrame) -> DataFrame:
    lower = upper.where(F.col("column_a") != F.col("column_b")).select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "n", "r"
    )
    return upper.unionByName(lower)


def pearson(source: DataFrame | Sums, columns: Sequence[str]) -> DataFrame:
    """``(column_a, column_b, n, r)`` over rows complete in all columns, from one aggregate or the statistics at hand.

    A pair with a constant column has a null r, also on the diagonal.
    """
    parts = [
        F.struct(
            F.lit(a).alias("column_a"),
            F.lit(b).alias("column_b"),
            F.col("n"),
            (
                F.when(F.col(m2_of(a)) > 0, F.lit(1.0))
                if a == b
                else ratio(cross_of(columns, a, b), F.sqrt(m2_of(a)) * F.sqrt(m2_of(b)))
            ).alias("r"),
        )
        for a, b in combinations_with_replacement(columns, 2)
    ]
    return _both_triangles(joint(source, columns).select(F.inline(F.array(*parts))))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation in the same form.

    Equal rows are counted once, with a weight, before ranks are joined to them, so a value held
    by much of the table neither repeats in the rank join nor in the sums. The counted rows are
    written, so the sales lines are read once. Spark broadcasts the ranks of a column if its few
    distinct values are small by file size, and joins by value otherwise.
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    distinct = materialize(complete.groupBy(*columns).agg(F.count(F.lit(1)).alias("_w")), "distinct-rows")
    ranked = distinct
    for c in columns:
        ranks = average_ranks(distinct, [c], weight="_w")
        ranked = ranked.join(ranks.select(F.col("value").alias(c), F.col("rank").alias(f"_rank_{c}")), c)
    total = distinct.agg(F.sum("_w").alias("n")).scalar()
    centred = ranked.select("_w", *[(F.col(f"_rank_{c}") - (total + 1) / 2.0).alias(c) for c in columns])

    def moment(a: str, b: str) -> Column:
        return F.sum(F.col("_w") * F.col(a) * F.col(b))

    parts = [
        F.struct(
            F.lit(a).alias("column_a"),
            F.lit(b).alias("column_b"),
            F.sum("_w").alias("n"),
            (
                F.when(moment(a, a) > 0, F.lit(1.0))
                if a == b
                else ratio(moment(a, b), F.sqrt(moment(a, a)) * F.sqrt(moment(b, b)))
            ).alias("r"),
        )
        for a, b in combinations_with_replacement(columns, 2)
    ]
    return _both_triangles(centred.agg(F.array(*parts).alias("rows")).select(F.inline("rows")))


def r_to_t(r: Column, n: Column) -> Column:
    """t statistic of a correlation; infinite for a perfect one."""
    spare = (1 - r) * (1 + r)
    return F.when(spare <= 0, F.lit(float("inf"))).otherwise(r * F.sqrt(ratio(n - 2, spare)))


def correlation_with_pvalues(
    df: DataFrame, columns: Sequence[str], method: str = "pearson", digits: int = 4, sums: Sums | None = None
) -> DataFrame:
    """Matrix of r and p in long form; p is 1 on the diagonal and null where r is."""
    matrix = {"pearson": lambda: pearson(sums or df, columns), "spearman": lambda: spearman(df, columns)}[method]()
    n = F.col("n").cast("double")
    p = F.when(F.col("column_a") == F.col("column_b"), F.lit(1.0)).otherwise(t_p(r_to_t(F.col("r"), n), n - 2))
    return matrix.select(
        "column_a", "column_b", "n", half_even(F.col("r"), digits).alias("r"), half_even(p, digits).alias("p_value")
    )
