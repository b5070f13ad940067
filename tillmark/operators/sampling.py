"""Seeded samples and splits that do not depend on partitioning.

Each row is placed by a hash of its key columns and the seed, so the same rows are chosen on
any cluster. Key columns should be integers or text.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_SEED = int(os.environ.get("TILLMARK_SEED", "7"))
SPLIT_BUCKETS = 10_000

# Key of a sales line: amounts enter as whole cents because doubles print differently elsewhere.
SALES_KEY = ("boleta", "sku", "local", "monto_aplicado")


def sales_key() -> list[Column]:
    return [
        F.col("boleta"),
        F.col("sku").cast("bigint"),
        F.col("local").cast("bigint"),
        F.floor(F.col("monto_aplicado") * 100),
    ]


def row_hash(keys: Sequence[Column | str], seed: int = DEFAULT_SEED) -> Column:
    """60-bit hash of the key columns and the seed."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def train_flag(keys: Sequence[Column | str], seed: int = DEFAULT_SEED, ratio: float = 0.7) -> Column:
    """True for about ``ratio`` of the rows, by their keys."""
    return row_hash(keys, seed) % SPLIT_BUCKETS < int(round(ratio * SPLIT_BUCKETS))


def hash_split(df: DataFrame, keys: Sequence[Column | str], seed: int = DEFAULT_SEED, ratio: float = 0.7) -> DataFrame:
    """Add ``is_train``, true for about ``ratio`` of the rows."""
    return df.withColumn("is_train", train_flag(keys, seed, ratio))


def sample_rows(
    df: DataFrame,
    n: int,
    keys: Sequence[Column | str],
    seed: int = DEFAULT_SEED,
    label: str | None = None,
    labels: Sequence = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows with the lowest hash, or the lowest ``n`` of each of the given ``labels``.

    A count per length of the hash in digits (at most 15 numbers per label) shows below which
    length at least ``n`` rows lie. Only those rows, some ``n`` to ``16n``, are sorted. ``ties``
    orders rows with equal keys. A column ``_hash`` that is there already is used as it is.
    """
    hashed = df if "_hash" in df.columns else df.withColumn("_hash", row_hash(keys, seed))
    hashed = hashed.withColumn("_digits", F.length(F.hex("_hash")))
    by = [label] if label else []
    if label:
        hashed = hashed.where(F.col(label).isin(list(labels)))
    running = W.partitionBy(*by).orderBy("_digits").rowsBetween(W.unboundedPreceding, W.currentRow)
    levels = hashed.groupBy(*by, "_digits").agg(F.count(F.lit(1)).alias("_n"))
    reached = levels.withColumn("_enough", F.sum("_n").over(running) >= n)
    cut = F.coalesce(F.min(F.when(F.col("_enough"), F.col("_digits"))), F.max("_digits")).alias("_cut")
    order = ["_hash", *ties]
    if label:
        # one row per entry of labels
        near = hashed.join(F.broadcast(reached.groupBy(label).agg(cut)), label).where(F.col("_digits") <= F.col("_cut"))
        ranked = near.withColumn("_place", F.row_number().over(W.partitionBy(label).orderBy(*order)))
        return ranked.where(F.col("_place") <= n).drop("_hash", "_digits", "_cut", "_place")
    near = hashed.where(F.col("_digits") <= reached.agg(cut).scalar())
    return near.orderBy(*order).limit(n).drop("_hash", "_digits")


def first_rows(df: DataFrame, n: int | None, order_by: Sequence[str] = ()) -> DataFrame:
    """Row cap; none or 0 means no cap. With ``order_by`` the cap is repeatable."""
    if not n:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(n)
