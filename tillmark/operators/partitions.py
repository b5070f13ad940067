"""Table functions applied to pieces of a DataFrame.

A function on a piece takes a pandas DataFrame, one Arrow batch of rows, and returns one, or None for
nothing. A function on a whole group takes an iterator of the group's batches, so it need not hold them
together; ``whole`` adapts one that must.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.session import materialize

PieceFunction = Callable[..., "pd.DataFrame | None"]
GroupFunction = Callable[..., "pd.DataFrame | None"]
StreamFunction = Callable[..., "Iterator[pd.DataFrame]"]
#: Rows of a range that one call sees.
ROWS_PER_RANGE = 100_000
#: Rows that one call of a function on parts of groups may see; what it returns is merged, so the number changes no result.
ROWS_PER_CALL = 200_000
MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def map_partitions(df: DataFrame, func: PieceFunction, schema: str, n_partitions: int | None = None, **kwargs) -> DataFrame:
    """Apply ``func`` to arbitrary row ranges, one Arrow batch a call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            result = func(batch, **kwargs) if len(batch) else None
            if result is not None:
                yield result

    pieces = df.repartition(n_partitions) if n_partitions else df
    return pieces.mapInPandas(run, schema)


def whole(func: PieceFunction) -> GroupFunction:
    """A function on batches from one that needs all rows of a group in one frame."""
    return lambda batches, **kwargs: func(pd.concat(list(batches), ignore_index=True), **kwargs)


def map_groups(df: DataFrame, func: GroupFunction, schema: str, by: Sequence[str], **kwargs) -> DataFrame:
    """Apply ``func`` to each whole group, given as an iterator of its batches.

    Groups stay whole at any size and are streamed to the function. Rows with a null key are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        result = func(batches, **kwargs)
        if result is not None:
            yield result

    return df.dropna(subset=list(by)).groupBy(*by).applyInPandas(run, schema)


def map_by_key(df: DataFrame, func: StreamFunction, schema: str, key: str, n_buckets: int | None = None, **kwargs) -> DataFrame:
    """Apply ``func`` to buckets of keys: rows with one key are in one bucket, next to each other.

    ``func`` is called once a bucket, with an iterator of frames in order of the key, many keys to a frame, and yields
    frames; :func:`whole_keys` and :func:`merged_keys` make one from a function on frames. A bucket is streamed,
    so neither it nor a key need fit in memory. Rows with a null key are left out. Functions whose partial
    results merge spread a hot key over all tasks with :func:`map_group_parts`.
    """
    dealt = df.dropna(subset=[key])
    dealt = dealt.repartition(n_buckets, key) if n_buckets else dealt.repartition(key)
    return dealt.sortWithinPartitions(key).mapInPandas(functools.partial(func, **kwargs) if kwargs else func, schema)


def whole_keys(func: PieceFunction, key: str) -> StreamFunction:
    """A stream function from one on frames that hold all rows of their keys; the last key of a frame waits for the next."""

    def run(frames: Iterator[pd.DataFrame], **kwargs) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in (f for f in frames if len(f)):
            complete = int((frame[key] != frame[key].iloc[-1]).sum())
            if held and complete == 0 and frame[key].iloc[0] != held[-1][key].iloc[-1]:
                complete, held = -1, [pd.concat(held, ignore_index=True), frame]
            if complete > 0:
                held.append(frame.iloc[:complete])
            if complete:
                ready = held[:-1] if complete < 0 else held
                yield from _results(func(pd.concat(ready, ignore_index=True), **kwargs))
                held = held[-1:] if complete < 0 else [frame.iloc[complete:]]
            else:
                held.append(frame)
        if held:
            yield from _results(func(pd.concat(held, ignore_index=True), **kwargs))

    return run


def merged_keys(func: PieceFunction, key: str, merge: Mapping[str, str]) -> StreamFunction:
    """A stream function from one that gives a row per key of a frame, in their order; a key's rows of two frames merge."""

    def run(frames: Iterator[pd.DataFrame], **kwargs) -> Iterator[pd.DataFrame]:
        last = None
        for frame in (f for f in frames if len(f)):
            part = func(frame, **kwargs).reset_index(drop=True)
            if last is not None and last[key].iloc[0] == part[key].iloc[0]:
                both = pd.concat([last, part.iloc[:1]], ignore_index=True)
                for column, how in merge.items():
                    part.loc[0, column] = both[column].agg(how)
            elif last is not None:
                yield last
            last = part.iloc[-1:]
            yield part.iloc[:-1]
        if last is not None:
            yield last

    return run


def _results(found: pd.DataFrame | None) -> list[pd.DataFrame]:
    return [] if found is None else [found]


def map_ranges(df: DataFrame, func: PieceFunction, schema: str, order_by: Sequence[str], rows_per_range: int = ROWS_PER_RANGE, **kwargs) -> DataFrame:
    """Apply ``func`` to consecutive ranges of ``rows_per_range`` rows in the given order; results carry their range's ``ordinal``.

    Rows are dealt out by value ranges and numbered there, with the sizes of the partitions before, a row each, as
    offsets; then each range is gathered by its number, in order. A range is the same whatever the partitioning if
    ``order_by`` tells rows apart. ``ordinal`` counts from zero and orders the results.
    """
    order = [F.col(c) for c in order_by]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the low 33 bits of the increasing id count the rows of a partition
    placed = materialize(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "placed")
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(F.col("_part"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(offsets, "_part").withColumn("_row", F.col("_before") + F.col("_at"))
    ranges = numbered.withColumn("ordinal", F.floor(F.col("_row") / rows_per_range)).drop("_part", "_at", "_before")
    inner = lambda frame: func(frame.drop(columns=["ordinal", "_row"]), **kwargs)

    def numbered_result(frame: pd.DataFrame) -> pd.DataFrame | None:
        found = inner(frame)
        return None if found is None else found.assign(ordinal=frame["ordinal"].iloc[0])

    def each(frame: pd.DataFrame) -> pd.DataFrame | None:
        parts = [numbered_result(piece) for _, piece in frame.groupby("ordinal", sort=False)]
        kept = [p for p in parts if p is not None]
        return pd.concat(kept, ignore_index=True) if kept else None

    dealt = ranges.repartition("ordinal").sortWithinPartitions("ordinal", "_row")
    return dealt.mapInPandas(whole_keys(each, "ordinal"), f"{schema}, ordinal bigint")


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches joined into frames of about ROWS_PER_CALL rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= ROWS_PER_CALL:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def map_group_parts(
    df: DataFrame, func: PieceFunction, schema: str, by: Sequence[str], merge: Mapping[str, str], keyed: bool = False, **kwargs
) -> DataFrame:
    """Two-phase aggregate by group: ``func`` on the part of a group within some batches, then ``merge``.

    For functions that merge: ``merge`` says how each result column is combined ("sum", "min" or
    "max"). Rows are not shuffled, only the partial results are, so a group of any size is spread
    over all tasks. Rows with a null key are left out.

    A ``keyed`` function gets rows of many groups and returns a row for each, its keys among the columns; its
    calls grow with the rows only. Otherwise each call sees one group, and a task's rows are first put in order
    of their groups, so that it calls a group once, or once for each ``ROWS_PER_CALL`` rows of it.
    """
    by = list(by)

    def on_pieces(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for key, piece in batch.groupby(by, sort=False):
            result = func(piece, **kwargs)
            if result is not None:
                yield result.assign(**dict(zip(by, key)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _gather(batches):
            parts = _results(func(batch, **kwargs)) if keyed else list(on_pieces(batch))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    rows = df.dropna(subset=by)
    partial = (rows if keyed else rows.sortWithinPartitions(*by)).mapInPandas(run, schema)
    return partial.groupBy(*by).agg(*[MERGES[how](c).alias(c) for c, how in merge.items()])


def sales_partials(piece: pd.DataFrame) -> pd.DataFrame:
    """Row count and amount of a piece of the sales table."""
    return pd.DataFrame({"n_rows": [len(piece)], "sum_monto": [float(piece["monto_aplicado"].sum())]})


def shop_partials(rows: pd.DataFrame) -> pd.DataFrame:
    """The same for each shop that occurs among the rows."""
    return rows.groupby("local", as_index=False, sort=False).agg(n_rows=("local", "size"), sum_monto=("monto_aplicado", "sum"))


def combine_totals(partials: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the sums of the partial numbers; no rows if there are none."""
    summed = partials.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in columns])
    return summed.where(F.col("_n") > 0).drop("_n")
