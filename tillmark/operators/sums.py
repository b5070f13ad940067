"""One table of sufficient statistics for everything that means, variances and cross products decide.

A single aggregate over the lines gives, for each group of the named keys and each pattern of nulls that occurs, the
row count and per column the mean, extremes and centred power sums, and centred products of the wanted pairs. Its rows
merge exactly, so descriptive moments, z-scores, correlations over complete rows, group tests, simple regression,
variance inflation and scaling all read this one small table instead of the lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.expressions import ratio
from tillmark.session import MOST_FIELDS, materialize, setting

#: A pattern of nulls is a long of one bit a column.
MAX_COLUMNS = 62
#: Rows whose means are the provisional centres.
CENTRE_ROWS = 1_000


@dataclass(frozen=True)
class Sums:
    """``table`` has a row per group of ``by`` and pattern of nulls in ``columns``, of the columns named by ``_part``."""

    table: DataFrame
    columns: tuple[str, ...]
    paired: tuple[str, ...] = ()
    shaped: tuple[str, ...] = ()
    by: tuple[str, ...] = ()

    def written(self) -> Sums:
        """The same with the table computed once."""
        with setting(self.table.sparkSession, MOST_FIELDS, "1000"):
            return replace(self, table=materialize(self.table, "sums"))

    def where(self, condition: Column) -> Sums:
        """Only the groups of which ``condition``, on the keys, holds."""
        return replace(self, table=self.table.where(condition))

    def labelled(self, name: str, label: Column) -> Sums:
        """With one more key, an expression of the others."""
        return replace(self, table=self.table.withColumn(name, label), by=(*self.by, name))

    def complete(self, columns: Sequence[str]) -> DataFrame:
        """The rows of patterns without a null in ``columns``."""
        bits = sum(1 << self.columns.index(c) for c in columns)
        return self.table.where(F.col("nulls").bitwiseAND(bits) == 0)


def _part(kind: str, *columns: str) -> str:
    return "_".join(("", kind, *columns))


def collect_sums(df: DataFrame, columns: Sequence[str], paired: Sequence[str] = (), shaped: Sequence[str] = (), by: Sequence[str] = ()) -> Sums:
    """One pass over ``df``. Products are kept for all pairs of ``paired`` and third and fourth powers for ``shaped`` columns.

    Keys should have few values; null keys are groups of their own. Powers are summed of the distance to a
    provisional centre, the mean of some rows, and moved to each group's mean afterwards, so a large
    mean costs no digits. Any centre gives the same sums but for rounding.
    """
    columns = list(dict.fromkeys([*columns, *paired, *shaped]))
    if len(columns) > MAX_COLUMNS:
        raise ValueError(f"at most {MAX_COLUMNS} columns")
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    some = numbers.limit(CENTRE_ROWS).agg(*[F.avg(c).alias(c) for c in columns]).first()
    centre = {c: some[c] or 0.0 for c in columns}
    nulls = [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(0).cast("bigint") for k, c in enumerate(columns)]
    moved = [(F.col(c).cast("double") - centre[c]).alias(_part("x", c)) for c in columns]
    rows = df.select(*by, sum(nulls[1:], nulls[0]).alias("nulls"), *moved)
    x = {c: F.col(_part("x", c)) for c in columns}
    parts = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        parts += [F.min(x[c]).alias(_part("min", c)), F.max(x[c]).alias(_part("max", c))]
        parts += [F.sum(x[c]).alias(_part("s1", c)), F.sum(x[c] * x[c]).alias(_part("s2", c))]
        if c in shaped:
            square = x[c] * x[c]
            parts += [F.sum(square * x[c]).alias(_part("s3", c)), F.sum(square * square).alias(_part("s4", c))]
    parts += [F.sum(x[a] * x[b]).alias(_part("s11", a, b)) for a, b in combinations(paired, 2)]
    found = rows.groupBy(*by, "nulls").agg(*parts)
    n, kept = F.col("n"), [*by, "nulls", "n"]
    for c in columns:
        low, high = F.col(_part("min", c)), F.col(_part("max", c))
        varies = low < high
        m = F.col(_part("s1", c)) / n
        s2 = F.col(_part("s2", c))
        least = lambda value: F.when(varies, value).when(~varies, 0.0)  # noqa: B023, E731
        kept += [(low + centre[c]).alias(_part("min", c)), (high + centre[c]).alias(_part("max", c))]
        kept += [(F.when(varies, m).otherwise(low) + centre[c]).alias(_part("mean", c))]
        kept.append(least(F.greatest(F.lit(0.0), s2 - n * m * m)).alias(_part("m2", c)))
        if c in shaped:
            s3, s4 = F.col(_part("s3", c)), F.col(_part("s4", c))
            kept.append(least(s3 - 3 * m * s2 + 2 * n * m**3).alias(_part("m3", c)))
            kept.append(least(s4 - 4 * m * s3 + 6 * m * m * s2 - 3 * n * m**4).alias(_part("m4", c)))
    for a, b in combinations(paired, 2):
        s1 = F.col(_part("s1", a)) * F.col(_part("s1", b))
        kept.append((F.col(_part("s11", a, b)) - s1 / n).alias(_part("cross", a, b)))
    return Sums(found.select(*kept), tuple(columns), tuple(paired), tuple(shaped), tuple(by))


def _varying(column: str, value: Column) -> Column:
    """``value``, or exactly zero if all merged rows hold one number."""
    return F.when(F.min(_part("min", column)) < F.max(_part("max", column)), value).when(F.min(_part("min", column)).isNotNull(), 0.0)


def univariate(source: DataFrame | Sums, columns: Sequence[str]) -> DataFrame:
    """``(variable, count, mean, m2, m3, m4, min, max)``: each column over its own non-null values, one row per column."""
    found = source if isinstance(source, Sums) else collect_sums(source, columns, shaped=columns)
    every = W.partitionBy()  # rows of the small table
    names = {c: {kind: F.col(_part(kind, c)) for kind in ("mean", "m2", "m3", "m4", "min", "max")} for c in columns}
    held = {c: F.when(names[c]["mean"].isNotNull(), F.col("n")) for c in columns}
    centre = {c: ratio(F.sum(held[c] * names[c]["mean"]).over(every), F.sum(held[c]).over(every)).alias(_part("all", c)) for c in columns}
    rows = found.table.select("*", *centre.values())
    parts = []
    for c in columns:
        n, off = held[c], names[c]["mean"] - F.col(_part("all", c))
        m2 = names[c]["m2"]
        m3, m4 = (names[c]["m3"], names[c]["m4"]) if c in found.shaped else (F.lit(None).cast("double"),) * 2
        parts.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.coalesce(F.sum(n), F.lit(0)).alias("count"),
                F.first(_part("all", c)).alias("mean"),
                _varying(c, F.sum(m2 + n * off**2)).alias("m2"),
                _varying(c, F.sum(m3 + 3 * off * m2 + n * off**3)).alias("m3"),
                _varying(c, F.sum(m4 + 4 * off * m3 + 6 * off**2 * m2 + n * off**4)).alias("m4"),
                F.min(names[c]["min"]).alias("min"),
                F.max(names[c]["max"]).alias("max"),
            )
        )
    return rows.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))


def joint(source: DataFrame | Sums, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Statistics of the rows complete in ``columns``, one row per group of ``by`` (without it one row, also of nothing).

    Columns ``n``, and for each column ``mean``, ``m2``, ``min`` and ``max``, and ``cross`` for each pair, named by ``mean_of`` and so on.
    """
    columns, by = list(columns), list(by)
    found = source if isinstance(source, Sums) else collect_sums(source, columns, paired=columns, by=by)
    group = W.partitionBy(*by)
    n = F.col("n")
    means = [ratio(F.sum(n * F.col(_part("mean", c))).over(group), F.sum(n).over(group)).alias(_part("all", c)) for c in columns]
    rows = found.complete(columns).select("*", *means)
    off = {c: F.col(_part("mean", c)) - F.col(_part("all", c)) for c in columns}
    parts = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    for c in columns:
        parts += [
            F.first(_part("all", c)).alias(mean_of(c)),
            _varying(c, F.sum(F.col(_part("m2", c)) + n * off[c] ** 2)).alias(m2_of(c)),
            F.min(_part("min", c)).alias(f"min_{c}"),
            F.max(_part("max", c)).alias(f"max_{c}"),
        ]
    for a, b in combinations(columns, 2):
        if a in found.paired and b in found.paired:
            kept = (a, b) if found.paired.index(a) < found.paired.index(b) else (b, a)
            parts.append(F.sum(F.col(_part("cross", *kept)) + n * off[a] * off[b]).alias(f"cross_{a}_{b}"))
    return rows.groupBy(*by).agg(*parts)


def mean_of(column: str) -> str:
    return f"mean_{column}"


def m2_of(column: str) -> str:
    return f"m2_{column}"


def cross_of(columns: Sequence[str], a: str, b: str) -> Column:
    """Centred product of two columns of ``joint(..., columns)``, in either order; of one with itself its square sum."""
    if a == b:
        return F.col(m2_of(a))
    first, second = (a, b) if list(columns).index(a) < list(columns).index(b) else (b, a)
    return F.col(f"cross_{first}_{second}")
