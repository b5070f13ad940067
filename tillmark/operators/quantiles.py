"""Exact order statistics.

Quantiles are bracketed first: one pass of rank sketches, all columns at once, gives for each wanted position two
values on either side of it. While a bracket may hold many rows, another pass counts what lies below it, exactly, and
sketches what lies inside, which narrows it a few hundred times. At last the distinct values inside, some thousands of
rows, are counted and sorted, and no column is shuffled. The exact counts show if a sketch missed a position; such a
bracket is opened on that side and narrowed again.

Ranks need every distinct value. Values are counted, map-side combined, so that one that fills a third of
the table is one row; the counts are dealt out by value ranges, each range is summed by its own task, and
a small table of range totals carries the counts across ranges.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.expressions import ratio
from tillmark.session import materialize

#: A sketch misses a rank by about n / ACCURACY, and by a rank or two of few rows. A bracket reaches the first of
#: these shares of the rows to both sides that is worth LEAST_RANKS rows.
ACCURACY = 4_000
REACHES = (1e-3, 1e-2, 1e-1, 1.0)
LEAST_RANKS = 6
#: A bracket that may hold more rows than FEW is narrowed by an inner sketch of GRID steps.
FEW = 200_000
GRID = 1_024
#: After so many turns a bracket is counted as it is; narrowing takes two or three at any size.
MAX_ROUNDS = 12
#: Brackets of so many groups may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 20_000


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), carried: Sequence[Column] = ()) -> DataFrame:
    """Long table ``(by..., carried..., variable, value)``, nulls included; rows with a null ``by`` key are left out."""
    # also for one column, whose name as a literal would fold the joins on it into cross joins
    wide = df.select(*by, *carried, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([c for c in wide.columns if c not in columns], list(columns), "variable", "value")
    return long.dropna(subset=list(by)) if by else long


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    weight: str | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Long table ``(by..., variable, value, n, extra...)`` of distinct non-null values.

    Rows with a null ``by`` key are left out. ``weight`` names a column of row multiplicities;
    ``extra`` adds row-level columns that are summed beside ``n``.
    """
    extra = dict(extra or {})
    carried = [c.alias(name) for name, c in extra.items()]
    carried.append((F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_weight"))
    long = long_values(df, columns, by, carried).where(F.col("value").isNotNull())
    sums = [F.sum("_weight").alias("n"), *[F.sum(name).alias(name) for name in extra]]
    return long.groupBy(*by, "variable", "value").agg(*sums)


def cumulative_counts(counts: DataFrame, by: Sequence[str] = (), sums: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``cum`` (rows with this value or a smaller one) to a table of value counts, or the running ``sums`` (name to count column).

    The counts are written once, in value ranges. Ranges are summed apart, so no task sorts more than
    its own; the joined side has one row per group, column and range.
    """
    keys = [*by, "variable"]
    dealt = counts.repartitionByRange(*keys, "value").withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt, "value-counts")
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = dict(sums or {"cum": "n"})
    offsets = dealt.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_inside_{name}") for name, c in sums.items()])
    before = [F.coalesce(F.sum(f"_inside_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums]
    offsets = offsets.select(*keys, "_range", *before)
    upto = W.partitionBy(*keys, "_range").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = dealt.withColumns({f"_upto_{name}": F.sum(c).over(upto) for name, c in sums.items()}).join(offsets, [*keys, "_range"])
    running = running.withColumns({name: F.col(f"_before_{name}") + F.col(f"_upto_{name}") for name in sums})
    return running.drop("_range", *[f"{part}_{name}" for name in sums for part in ("_before", "_upto")])


def mid_rank() -> Column:
    """Average rank of a value, ties sharing the mean of their positions."""
    return F.col("cum") - (F.col("n") - 1) / F.lit(2.0)


def average_ranks(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Average rank of each distinct value: ``(by..., variable, value, n, rank)``."""
    ranked = cumulative_counts(value_counts(df, columns, by, weight=weight), by)
    return ranked.select(*by, "variable", "value", "n", mid_rank().alias("rank"))


@dataclass
class _Bracket:
    """One wanted quantile of the whole table: its ranks from one, and two values that should lie around them."""

    column: str
    n: int
    first: int
    second: int
    part: float
    low: float
    high: float
    safe: tuple[float, float] = (-math.inf, math.inf)
    settled: bool = False
    found: tuple[float, float] | None = None


def _bracket(column: str, n: int, p: float, edges: Sequence[float]) -> _Bracket:
    """The narrowest pair of ``edges`` (low and high of each reach) that a sketch of ``n`` values can vouch for."""
    rung = next((k for k, reach in enumerate(REACHES[:-1]) if n * reach >= LEAST_RANKS), len(REACHES) - 1)
    place = p * (n - 1)
    first = math.floor(place)
    return _Bracket(column, n, first + 1, math.ceil(place) + 1, place - first, edges[2 * rung], edges[2 * rung + 1])


def _settle(rows: DataFrame, brackets: list[_Bracket]) -> None:
    """Count below and in brackets: open a missed side, or take the value that fills one, or narrow a wide one."""
    waiting = [b for b in brackets if not b.settled]
    counts = [F.count_if(F.col(b.column) < b.low) for b in waiting] + [F.count_if(F.col(b.column) <= b.high) for b in waiting]
    counted = rows.agg(F.array(*counts)).first()[0]
    wide = []
    for b, below, upto in zip(waiting, counted, counted[len(waiting) :]):
        if below >= b.first:
            b.low = -math.inf
        if upto < b.second:
            b.high = math.inf
        if below >= b.first or upto < b.second:
            continue
        b.safe = (b.low, b.high)
        if b.low == b.high:
            b.found = b.safe
        b.settled = b.low == b.high or upto - below <= FEW
        if not b.settled:
            wide.append((b, below, upto - below))
    if wide:
        steps = [g / GRID for g in range(GRID + 1)]
        inside = [F.percentile_approx(F.when(F.col(b.column).between(b.low, b.high), F.col(b.column)), steps, ACCURACY) for b, *_ in wide]
        for (b, below, held), grid in zip(wide, rows.agg(F.array(*inside)).first()[0]):
            b.low = grid[max(0, (b.first - 1 - below) * GRID // held - 1)]
            b.high = grid[min(GRID, -((below - b.second) * GRID // held) + 1)]
            b.settled = (b.low, b.high) == b.safe  # as many rows, but few values


def _pick(rows: DataFrame, brackets: list[_Bracket]) -> None:
    """Sort the counts of the distinct values inside the brackets, and take those at the two ranks of each."""
    within = [F.col(b.column).between(b.low, b.high) for b in brackets]
    counts = rows.agg(F.array(*[F.count_if(F.col(b.column) < b.low) for b in brackets])).first()[0]
    # few rows lie in a bracket; the others leave before any array is made of them
    met = [F.when(hit, F.struct(F.lit(k).alias("k"), F.col(b.column).alias("value"))) for k, (hit, b) in enumerate(zip(within, brackets))]
    some = rows.where(functools.reduce(lambda a, b: a | b, within)).select(F.explode(F.array_compact(F.array(*met))).alias("b"))
    upto = W.partitionBy("k").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = some.groupBy("b.k", "b.value").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(upto))
    rank = lambda values: F.get(F.lit([v - below for v, below in zip(values, counts)]).cast("array<bigint>"), F.col("k"))
    at = [F.min(F.when(F.col("upto") >= rank([getattr(b, name) for b in brackets]), F.col("value"))).alias(name) for name in ("first", "second")]
    for r in ranked.groupBy("k").agg(*at).collect():  # a row per wanted quantile
        brackets[r["k"]].found = (r["first"], r["second"])


def _whole_quantiles(rows: DataFrame, columns: Sequence[str], wanted: Sequence[float]) -> list[tuple[int, list[float]]]:
    """``(n, values)`` of each column, by as many passes as it takes; what they leave on the driver is a few numbers a quantile."""
    edges = [min(1.0, max(0.0, p + side * reach)) for p in wanted for reach in REACHES for side in (-1, 1)]
    sketch = rows.agg(F.array(*[F.count(c) for c in columns]).alias("n"), F.array(*[F.percentile_approx(c, edges, ACCURACY) for c in columns]).alias("edges")).first()
    size = 2 * len(REACHES)
    table = [
        [_bracket(c, n, p, own[size * j : size * (j + 1)]) for j, p in enumerate(wanted)] if n else []
        for c, n, own in zip(columns, sketch["n"], sketch["edges"])
    ]
    brackets = [b for line in table for b in line]
    for _ in range(MAX_ROUNDS):
        _settle(rows, brackets)
        if all(b.settled for b in brackets):
            break
    for b in brackets:
        b.low, b.high = b.safe
    left = [b for b in brackets if b.found is None]
    if left:
        _pick(rows, left)
    return [(line[0].n if line else 0, [b.found[0] + (b.found[1] - b.found[0]) * b.part for b in line]) for line in table]


class _State:
    """Brackets of groups: ``_n`` of each column, ``_low``, ``_high`` and ``_most`` (rows it may hold) of each column and probability."""

    def __init__(self, found: DataFrame):
        self.table = materialize(found, "brackets")

    def beside(self, df: DataFrame, by: Sequence[str]) -> DataFrame:
        """``df`` with its group's brackets."""
        renamed = self.table.withColumnsRenamed({c: f"_by_{c}" for c in by})
        renamed = F.broadcast(renamed) if self.table.count() <= BROADCAST_ROWS else renamed
        return df.join(renamed, _all([F.col(c) == F.col(f"_by_{c}") for c in by])).drop(*[f"_by_{c}" for c in by])

    def most(self) -> int:
        return self.table.agg(F.max(F.array_max("_most"))).first()[0] or 0


def _all(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)


def _first_brackets(rows: DataFrame, columns: Sequence[str], wanted: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Brackets around each position, from a sketch of every column."""
    edges = [min(1.0, max(0.0, p + side * reach)) for p in wanted for reach in REACHES for side in (-1, 1)]
    sketches = [F.percentile_approx(c, edges, ACCURACY).alias(f"_edges{i}") for i, c in enumerate(columns)]
    sketched = rows.groupBy(*by).agg(F.array(*[F.count(c) for c in columns]).alias("_n"), *sketches)
    low, high, most = [], [], []
    for i in range(len(columns)):
        n = F.get("_n", F.lit(i))
        rung, share = F.lit(len(REACHES) - 1), F.lit(1.0)
        for k, reach in reversed(list(enumerate(REACHES[:-1]))):
            rung = F.when(n * reach >= LEAST_RANKS, k).otherwise(rung)
            share = F.when(n * reach >= LEAST_RANKS, 2 * reach).otherwise(share)
        for j in range(len(wanted)):
            low.append(F.get(f"_edges{i}", 2 * len(REACHES) * j + 2 * rung))
            high.append(F.get(f"_edges{i}", 2 * len(REACHES) * j + 2 * rung + 1))
            most.append(F.ceil(share * n))
    return sketched.select(*by, "_n", F.array(*low).alias("_low"), F.array(*high).alias("_high"), F.array(*most).alias("_most"))


def _places(n: Column, p: float) -> tuple[Column, Column, Column]:
    """Ranks, from one, of the two values around a position, and the share of the second."""
    place = F.lit(p) * (n - 1)
    return F.floor(place) + 1, F.ceil(place) + 1, place - F.floor(place)


def _narrowed(rows: DataFrame, state: _State, columns: Sequence[str], wanted: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Brackets after a pass that counts below them and sketches inside; a side without its position opens."""
    each = [(c, i, j) for i, c in enumerate(columns) for j in range(len(wanted))]
    steps = [g / GRID for g in range(GRID + 1)]
    parts, kept = [], ["_n", "_low", "_high"]
    for k, (c, _, _) in enumerate(each):
        inside = F.col(c).between(F.get("_low", F.lit(k)), F.get("_high", F.lit(k)))
        parts += [
            F.count_if(F.col(c) < F.get("_low", F.lit(k))).alias(f"_below{k}"),
            F.count_if(inside).alias(f"_inside{k}"),
            F.percentile_approx(F.when(inside, F.col(c)), steps, ACCURACY).alias(f"_grid{k}"),
        ]
    found = state.beside(rows, by).groupBy(*by, *kept).agg(*parts)
    low, high, most = [], [], []
    for k, (_, i, j) in enumerate(each):
        n = F.get("_n", F.lit(i))
        first, second, _ = _places(n, wanted[j])
        below, inside, grid = F.col(f"_below{k}"), F.col(f"_inside{k}"), f"_grid{k}"
        left, right = below >= first, second > below + inside
        step = lambda rank: ratio((rank - below) * GRID, inside)  # noqa: B023, E731
        from_step = F.greatest(F.lit(0), F.floor(step(first - 1)) - 1).cast("int")
        to_step = F.least(F.lit(GRID), F.ceil(step(second)) + 1).cast("int")
        new_low = F.when(left, float("-inf")).when(right, F.get("_low", F.lit(k))).otherwise(F.get(grid, from_step))
        new_high = F.when(right, float("inf")).when(left, F.get("_high", F.lit(k))).otherwise(F.get(grid, to_step))
        missed = left | right
        low.append(new_low)
        high.append(new_high)
        still = (new_low == F.get("_low", F.lit(k))) & (new_high == F.get("_high", F.lit(k)))  # as many rows, but few values
        most.append(F.when(~missed & (still | (new_low >= new_high)), F.lit(0)).when(missed, n).otherwise(F.ceil(inside * (to_step - from_step) / GRID)))
    ns = F.array(*[F.get("_n", F.lit(i)) for i in range(len(columns))])
    return found.select(*by, ns.alias("_n"), F.array(*low).alias("_low"), F.array(*high).alias("_high"), F.array(*most).alias("_most"))


def _picked(rows: DataFrame, state: _State, columns: Sequence[str], wanted: Sequence[float], by: Sequence[str]) -> DataFrame:
    """A row per group, column and probability: the values at its two ranks, and on which side the bracket misses one."""
    each = [(c, i, j) for i, c in enumerate(columns) for j in range(len(wanted))]
    beside = state.beside(rows, by)
    within = [F.col(c).between(F.get("_low", F.lit(k)), F.get("_high", F.lit(k))) for k, (c, _, _) in enumerate(each)]
    counts = [F.count_if(F.col(c) < F.get("_low", F.lit(k))) for k, (c, _, _) in enumerate(each)]
    below = _State(beside.groupBy(*by).agg(F.array(*counts).alias("_below")))
    # few rows lie in a bracket; the others leave before any array is made of them
    some = beside.where(functools.reduce(lambda a, b: a | b, within))
    met = F.array(*[F.when(hit, F.struct(F.lit(k).alias("k"), F.col(c).alias("value"))) for k, (hit, (c, _, _)) in enumerate(zip(within, each))])
    inside = some.select(*by, F.explode(F.array_compact(met)).alias("b")).groupBy(*by, "b.k", "b.value").agg(F.count(F.lit(1)).alias("_c"))
    upto = W.partitionBy(*by, "k").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = inside.withColumn("_upto", F.sum("_c").over(upto))
    places = []
    for k, (_, i, j) in enumerate(each):
        n = F.get("_n", F.lit(i))
        first, second, part = _places(n, wanted[j])
        named = {"k": F.lit(k), "n": n, "below": F.get("_below", F.lit(k)), "first": first, "second": second, "part": part}
        places.append(F.struct(*[c.alias(name) for name, c in named.items()]))
    known = state.table.select(*by, "_n").join(below.table, list(by))
    known = known.select(*by, F.inline(F.array(*places))).where(F.col("n") > 0)
    found = known.join(inside, [*by, "k"], "left")
    at_rank = lambda rank: F.min(F.when(F.col("below") + F.col("_upto") >= F.col(rank), F.col("value")))
    reached = F.coalesce(F.max(F.col("below") + F.col("_upto")), F.lit(0))
    made = found.groupBy(*by, "k", "n", "below", "first", "second", "part").agg(at_rank("first").alias("a"), at_rank("second").alias("b"), reached.alias("reached"))
    return made.select(*by, "k", "n", "part", "a", "b", (F.col("below") >= F.col("first")).alias("left"), (F.col("reached") < F.col("second")).alias("right"))


def _opened(state: _State, picked: DataFrame, by: Sequence[str]) -> DataFrame:
    """The brackets with their missed sides opened."""
    sides = picked.groupBy(*by).agg(*[F.collect_list(F.when(F.col(side), F.col("k"))).alias(f"_{side}") for side in ("left", "right")])
    both = state.table.join(sides, list(by), "left")
    hit = lambda side, k: F.coalesce(F.array_contains(f"_{side}", k), F.lit(False))
    low = F.transform("_low", lambda x, k: F.when(hit("left", k), F.lit(float("-inf"))).otherwise(x))
    high = F.transform("_high", lambda x, k: F.when(hit("right", k), F.lit(float("inf"))).otherwise(x))
    most = F.transform("_most", lambda x, k: F.when(hit("left", k) | hit("right", k), F.lit(FEW + 1)).otherwise(x).cast("bigint"))
    return both.select(*by, "_n", low.alias("_low"), high.alias("_high"), most.alias("_most"))


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles per column (and ``by`` group): ``(by..., variable, n, <names>)``.

    A column without values has no row; rows with a null ``by`` key are left out. The passes run when this is
    called: each depends on what the one before found.
    """
    columns, by, names = list(columns), list(by), list(probabilities)
    wanted = [float(p) for p in probabilities.values()]
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_value{i}") for i, c in enumerate(columns)])
    rows = rows.dropna(subset=by) if by else rows
    values = [f"_value{i}" for i in range(len(columns))]
    if not by:
        found = [(c, n, *line) for c, (n, line) in zip(columns, _whole_quantiles(rows, values, wanted)) if n]
        return df.sparkSession.createDataFrame(found, ", ".join(["variable string", "n bigint", *[f"`{name}` double" for name in names]]))
    state = _State(_first_brackets(rows, values, wanted, by))
    for _ in range(MAX_ROUNDS):
        if state.most() > FEW:
            state = _State(_narrowed(rows, state, values, wanted, by))
            continue
        picked = materialize(_picked(rows, state, values, wanted, by), "picked")
        if picked.where("left or right").isEmpty():
            break
        state = _State(_opened(state, picked, by))
    else:  # sketches that do not help: all distinct values are counted
        ends = {"_low": float("-inf"), "_high": float("inf")}
        state = _State(state.table.withColumns({name: F.transform(name, lambda x: F.when(x.isNotNull(), F.lit(end))) for name, end in ends.items()}))  # noqa: B023
        picked = materialize(_picked(rows, state, values, wanted, by), "picked")
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    at = lambda j: F.max(F.when(F.col("k") % len(wanted) == j, value)).alias(names[j])
    index = F.floor(F.col("k") / len(wanted)).cast("int")
    named = F.get(F.array(*[F.lit(c) for c in columns]), index).alias("variable")
    return picked.groupBy(*by, named, "n").agg(*[at(j) for j in range(len(wanted))]).select(*by, "variable", "n", *names)


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], accuracy: int = 10_000
) -> DataFrame:
    """The same table from one pass of rank sketches, with rank error at most n / ``accuracy``."""
    names = list(probabilities)
    sketches = [
        F.struct(
            F.lit(c).alias("variable"),
            F.count(c).alias("n"),
            F.percentile_approx(F.col(c).cast("double"), [float(probabilities[k]) for k in names], accuracy).alias("q"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*sketches).alias("rows")).select(F.inline("rows"))
    return rows.select("variable", "n", *[F.col("q")[i].alias(k) for i, k in enumerate(names)])


def median_value(df: DataFrame, column: str) -> DataFrame:
    """One row, one column: the exact median, null for an empty column."""
    return quantiles(df, [column], {"median": 0.5}).agg(F.max("median").alias("median"))


def counted_median(counts: DataFrame, column: str, n: str) -> DataFrame:
    """The same of values counted in ``n``: exact, without a pass over the rows that were counted."""
    ranked = cumulative_counts(value_counts(counts, [column], weight=n))
    total = ranked.agg(F.max("cum").alias("total")).scalar()
    at = lambda rank: F.min(F.when(F.col("cum") >= rank, F.col("value")))
    both = ranked.agg(at(F.floor((total + 1) / 2)).alias("low"), at(F.ceil((total + 1) / 2)).alias("high"))
    return both.select((F.col("low") + (F.col("high") - F.col("low")) * 0.5).alias("median"))
