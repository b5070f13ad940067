"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a shuffled order. A document's virtual finish time is the cumulative
size of its source up to it, divided by the source's target; all documents are ranked by that time over
all sources, and the ranking is cut at the total budget. A source that must give more than it has sends
its documents again, up to ``MAX_COPIES`` times.

Cumulative sums are two-level: sums of hash buckets, their running totals, and a window inside each
bucket, so that a source with a third of all rows is spread over as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.native import SPACE, broadcast_if_small, pieces, whole
from tillmark.session import checkpointed

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
ROWS_PER_BUCKET = 5_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, weight, target)`` of one row per source with ``source_size``.

    Sources in code point order, null last, weigh as ``weights``, again and again. They share the sum of
    all sizes by weight, none above ``copies`` times its own size; what a full source leaves is shared by
    the others. With ``level`` = target / weight of those not full: a source is full if
    copies * size / weight is at most the level, so sources are filled in the order of that ratio.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", weight.alias("weight"))
    room = (copies * F.col("source_size")) / F.col("weight")
    order = Window.orderBy("room", F.col("source").isNull(), F.encode("source", "utf-8"))
    everything = Window.partitionBy()
    filled = weighed.withColumn("room", room)
    filled = filled.withColumn("before", F.coalesce(F.sum(copies * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    filled = filled.withColumn("weights_left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    filled = filled.withColumn("level", (F.sum("source_size").over(everything) - F.col("before")) / F.col("weights_left"))
    # The level if all sources before this one are full and it is not; the first that isn't full sets it.
    filled = filled.withColumn("level", F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", F.col("source").isNull().alias("n"), F.encode("source", "utf-8").alias("s"), "level"))).over(everything)["level"])
    return filled.select(
        "source", "source_size", "weight", F.least(copies * F.col("source_size").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def _shuffled() -> Column:
    """Place of a document in its source: a digest of both, the same in every run."""
    return F.md5(F.concat_ws(":", F.coalesce("source", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _running(rows: DataFrame, group: list[str], bucket: str, order: list, size: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``size`` up to and with each row, over buckets and the order within them."""
    key = [*group, bucket]
    sums = rows.groupBy(*key).agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in key], F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    joined = rows.join(sums, F.expr(" and ".join(f"`{k}` <=> `__{k}`" for k in key)))
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(name, F.col("__before") + F.sum(size).over(inside)).drop("__before", *[f"__{k}" for k in key])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken, digest)`` of every row of ``docs``.

    ``size`` is the number of words of the text, 0 for a null one. ``taken`` is how many of a row's words
    the mix takes, repeats counted: whole copies in the order of their finish time, and as much of the
    copy at the end as the budget, the sum of all sizes, leaves. Ties in finish time go by source, place,
    id, size and text; equal rows may swap places, which no result shows. A null source is a source of its own,
    a null ``doc_id`` sorts as an empty text. Sources without words have the target 0. Other columns are
    not read. No rows give no rows.
    """
    measured = docs.select("doc_id", "source", F.xxhash64(whole()).alias("digest"), F.size(pieces(whole(), SPACE)).cast("long").alias("size"))
    rows = checkpointed(measured)  # the digest of the text only tells rows with equal ids apart
    sources = checkpointed(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, copies))
    buckets = max(1, rows.count() // ROWS_PER_BUCKET)
    aims = broadcast_if_small(sources.select(F.col("source").alias("__source"), "source_size", "target"))
    placed = rows.withColumn("place", _shuffled()).withColumn("bucket", F.shiftright(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * buckets, 32))
    placed = _running(placed, ["source"], "bucket", ["place", "doc_id", "size", "digest"], "size", "sent")
    queued = placed.join(aims, F.expr("source <=> __source")).drop("__source", "bucket")
    queued = checkpointed(queued.withColumn("row", F.monotonically_increasing_id()))
    sent_again = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    waiting = queued.select("*", sent_again.alias("copy")).where("copy * source_size < target and size > 0")
    waiting = waiting.withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("sent")) / F.col("target"))
    waiting = waiting.withColumn("range", F.floor(F.col("finish") * buckets)).select("row", "source", "place", "doc_id", "size", "digest", "copy", "finish", "range")
    order = ["finish", F.col("source").isNull(), "source", "place", "doc_id", "size", "digest", "copy"]
    ranked = _running(waiting, [], "range", order, "size", "total")
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    used = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), budget - F.col("total") + F.col("size")))
    taken = ranked.groupBy(F.col("row").alias("__row")).agg(F.sum(used).alias("taken"))
    mixed = queued.join(taken, F.col("row") == F.col("__row"), "left")
    return mixed.select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "digest")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES) -> DataFrame:
    """The documents that the mix takes words of, with ``size``, ``source_size``, ``target`` and ``taken``.

    Rows that are equal in id, source and text are one row here, whose ``taken`` is their sum. Columns of
    ``docs`` with one of the four names are replaced.
    """
    key = ["doc_id", "source", "digest"]
    plan = mix(docs, weights, copies).where("taken > 0")
    plan = plan.groupBy(*key).agg(*[F.max(c).alias(c) for c in ("size", "source_size", "target")], F.sum("taken").alias("taken"))
    plan = plan.select(*[F.col(k).alias(f"__{k}") for k in key], "size", "source_size", "target", "taken")
    rows = docs.drop("size", "source_size", "target", "taken").withColumn("__text", F.xxhash64(whole()))
    same = "doc_id <=> __doc_id and source <=> __source and __text = __digest"
    found = rows.join(plan, F.expr(same)).dropDuplicates(["__doc_id", "__source", "__digest"])
    return found.drop("__text", *[f"__{k}" for k in key])
