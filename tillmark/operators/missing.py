"""Reports on missing values."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.expressions import half_even, ratio
from tillmark.schema import numeric_columns

MCAR_LIMIT = 0.3


def missing_report(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with count, percent and type, highest percent first."""
    parts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(F.col(f.name).isNull()).alias("n_missing"),
            half_even(ratio(F.count_if(F.col(f.name).isNull()), F.count(F.lit(1))) * 100, 2).alias("pct_missing"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
        )
        for f in df.schema
    ]
    rows = df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))
    return rows.where(F.col("n_missing") > 0).orderBy(F.desc("pct_missing"), "column")


#: Columns of one long of null flags.
FLAGS_PER_LONG = 62


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each pattern of nulls that occurs: ``_nulls0``, ``_nulls1``, ... (a bit a column, 62 to a long) and ``n``."""
    flags = [F.when(F.col(c).isNull(), F.lit(1 << (k % FLAGS_PER_LONG))).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(columns)]
    longs = [sum(flags[k + 1 : k + FLAGS_PER_LONG], flags[k]).alias(f"_nulls{k // FLAGS_PER_LONG}") for k in range(0, len(flags), FLAGS_PER_LONG)]
    return df.select(*longs).groupBy(*[f"_nulls{k}" for k in range(len(longs))]).agg(F.count(F.lit(1)).alias("n"))


def _is_null(k: int) -> str:
    return f"(_nulls{k // FLAGS_PER_LONG} & {1 << (k % FLAGS_PER_LONG)}L) != 0"


def missing_indicator_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absolute correlation between the null indicators of each pair, null if one is constant.

    The lines are counted by pattern; every pair then reads the few patterns.
    """
    columns = list(columns)
    pairs = list(combinations(range(len(columns)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    held = lambda condition: f"cast(coalesce(sum(if({condition}, n, 0)), 0) as double)"
    alone = [F.expr(f"{held(_is_null(k))} as a{k}") for k in range(len(columns))]
    both = [F.expr(f"{held(f'{_is_null(i)} and {_is_null(j)}')} as b{i}_{j}") for i, j in pairs]
    sums = null_patterns(df, columns).agg(F.sum("n").cast("double").alias("n"), *alone, *both)
    spread = lambda k: f"sqrt(a{k} * (n - a{k}))"
    phi = [f"abs(try_divide(n * b{i}_{j} - a{i} * a{j}, {spread(i)} * {spread(j)}))" for i, j in pairs]
    names = F.lit(columns)
    rows = sums.select(F.posexplode(F.expr(f"array({', '.join(phi)})")).alias("at", "correlation"))
    of = lambda side: F.get(names, F.get(F.lit([pair[side] for pair in pairs]), F.col("at")))
    return rows.select(of(0).alias("column_a"), of(1).alias("column_b"), "correlation")


def mcar_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: largest correlation between null indicators, and how to read it."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        return df.sparkSession.range(1).select(
            F.lit(None).cast("double").alias("max_correlation"), F.lit("no numeric columns").alias("message")
        )
    pairs = missing_indicator_pairs(df, columns)
    strongest = pairs.agg(F.coalesce(F.max("correlation"), F.lit(0.0)).alias("strongest"))
    some = null_patterns(df, columns).agg(F.expr(f"max({' or '.join(map(_is_null, range(len(columns))))}) as any_missing"))
    summary = strongest.select("strongest", some.scalar().alias("any_missing"))
    message = (
        F.when(~F.coalesce("any_missing", F.lit(False)), "no missing values")
        .when(F.col("strongest") < MCAR_LIMIT, "plausibly missing at random")
        .otherwise("possible systematic pattern")
    )
    return summary.select(
        F.when(F.col("any_missing"), F.col("strongest")).alias("max_correlation"), message.alias("message")
    )
