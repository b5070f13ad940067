"""Derived columns of a cleaned sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.functions.expressions import half_even, ratio, whole_days_between
from tillmark.operators.sums import Sums, univariate
from tillmark.session import buckets, materialize, materialize_by

MIN_AGE, MAX_AGE = 0, 100
DAYS_PER_YEAR = 365.25


def raw_age() -> Column:
    days = whole_days_between(F.col("fecha"), F.col("fecha_nacimiento"))
    return half_even(days / F.lit(DAYS_PER_YEAR), 1)


def is_implausible(age: Column) -> Column:
    return (age < MIN_AGE) | (age > MAX_AGE)


def median_age(df: DataFrame) -> DataFrame:
    """One row: median of plausible ages over the whole table, of all ages if none is plausible.

    Ages are tenths of years, so their counts are a small table however many rows there are.
    """
    age = F.col("age")
    counts = df.select(raw_age().alias("age")).where(age.isNotNull()).groupBy("age").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("plausible", ~is_implausible(age))
    kind = W.partitionBy("plausible")
    upto = F.sum("n").over(kind.orderBy("age").rowsBetween(W.unboundedPreceding, W.currentRow))
    every, whole = W.partitionBy(), W.orderBy("age").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.select(
        "age", "plausible", upto.alias("cum"), F.sum("n").over(kind).alias("total"), F.sum("n").over(whole).alias("cum_all"), F.sum("n").over(every).alias("all")
    )

    def median(cum: Column, total: Column) -> Column:
        low, high = F.floor((total + 1) / 2), F.ceil((total + 1) / 2)
        return (F.min(F.when(cum >= low, age)) + F.min(F.when(cum >= high, age))) / 2

    usual = F.when(F.col("plausible"), F.col("cum"))
    return ranked.agg(F.coalesce(median(usual, F.col("total")), median(F.col("cum_all"), F.col("all"))).alias("median_age"))


def add_age(df: DataFrame) -> DataFrame:
    fill = median_age(df).scalar()
    age = F.col("edad")
    return df.withColumn("edad", raw_age()).withColumn("edad", F.when(is_implausible(age), fill).otherwise(age))


def add_purchase_frequency(df: DataFrame) -> DataFrame:
    """Distinct receipts of the client on each of its rows; null for rows without a client."""
    frequency = (
        df.where(F.col("codigo_cliente").isNotNull())
        .groupBy("codigo_cliente")
        .agg(F.count_distinct("boleta").alias("frecuencia_compra"))
    )
    return df.join(frequency, "codigo_cliente", "left")


def add_items_per_receipt(df: DataFrame) -> DataFrame:
    """Lines of the receipt on each of its rows; null for rows without a receipt.

    A count per receipt joined back, not a window: a window would hold one receipt in one task.
    """
    items = df.where(F.col("boleta").isNotNull()).groupBy("boleta").agg(F.count(F.lit(1)).alias("items_por_boleta"))
    return df.join(items, "boleta", "left")


def add_calendar(df: DataFrame) -> DataFrame:
    day = F.weekday("fecha")
    return df.withColumns(
        {
            "hora": F.hour("fecha"),
            "dia_semana": day,
            "mes": F.month("fecha"),
            "anio": F.year("fecha"),
            "es_fin_de_semana": day.isin(5, 6),
        }
    )


def add_purchase_counts(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Both counts above, with the lines joined once.

    Lines are first counted per receipt and client. That small table gives the receipts of a client (its
    rows) and the lines of a receipt (their sum), and is joined to the lines on receipt and client. Lines that are
    ``dealt`` out by receipt (:func:`materialize_by`), none without one, stay where they are: the counts come to them.
    """
    receipt, client = F.col("boleta"), F.col("codigo_cliente")
    pairs = df.select(receipt, client).groupBy(receipt, client).agg(F.count(F.lit(1)).alias("_lines"))
    pairs = materialize_by(pairs, "purchases", "boleta") if dealt else materialize(pairs, "purchases")
    known = pairs.where(client.isNotNull()).groupBy(client.alias("_client")).agg(F.count("boleta").alias("frecuencia_compra"))
    items = pairs.where(receipt.isNotNull()).groupBy(receipt.alias("_receipt")).agg(F.sum("_lines").alias("items_por_boleta"))
    counted = pairs.join(items, receipt == F.col("_receipt"), "left").join(known, client == F.col("_client"), "left")
    counted = counted.select(receipt.alias("_boleta"), client.alias("_codigo"), "frecuencia_compra", "items_por_boleta")
    same = "boleta <=> _boleta and codigo_cliente <=> _codigo"
    if dealt:
        counted = counted.repartition(buckets(df.sparkSession), "_boleta").hint("shuffle_hash")
        same = "boleta = _boleta and codigo_cliente <=> _codigo"
    return df.join(counted, F.expr(same)).drop("_boleta", "_codigo")


def derive_features(df: DataFrame, dealt: bool = False) -> DataFrame:
    """All derived columns the input columns allow; ``dealt`` as for :func:`add_purchase_counts`."""
    df = df.withColumn("monto_por_unidad", ratio(F.col("monto_aplicado"), F.col("unidades")))
    if "fecha_nacimiento" in df.columns:
        df = add_age(df)
    order = df.columns
    if "boleta" in df.columns and "codigo_cliente" in df.columns:
        df = add_purchase_counts(df, dealt)
        order = [*order, "frecuencia_compra", "items_por_boleta"]
    elif "boleta" in df.columns:
        df = add_items_per_receipt(df)
        order = [*order, "items_por_boleta"]
    return add_calendar(df.select(*order))


def scaling_parameters(source: DataFrame | Sums, columns: Sequence[str]) -> DataFrame:
    """One row with the mean and population deviation of each column (1 for a constant column)."""
    deviation = F.sqrt(ratio(F.col("m2"), F.col("count")))
    scaled = univariate(source, columns).withColumn("scale", F.when(deviation == 0, 1.0).otherwise(deviation))
    pick = lambda c, name: F.max(F.when(F.col("variable") == c, F.col(name)))
    return scaled.agg(*[pick(c, name).alias(f"{c}_{kind}") for c in columns for kind, name in (("mean", "mean"), ("scale", "scale"))])


def standardize(df: DataFrame, columns: Sequence[str], parameters: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """Centre and scale columns, with parameters taken from ``df`` or given from an earlier fit."""
    parameters = scaling_parameters(df, columns) if parameters is None else parameters
    fitted = parameters.select(F.struct(*parameters.columns).alias("fitted")).scalar()
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c) - fitted[f"{c}_mean"]) / fitted[f"{c}_scale"] for c in columns}
    )
