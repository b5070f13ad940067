"""Sales lines as a view over star-schema Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order priority to sales channel; every other priority is a POS sale.
CHANNEL_OF_PRIORITY = {"1-URGENT": "APP", "2-HIGH": "WEB", "3-MEDIUM": "CCT"}
DEFAULT_CHANNEL = "POS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str, names: bool = False) -> DataFrame:
    """One row per receipt line, with missing and faulty values set by integer rules.

    ``names`` adds the product and client names. Nothing computes with them, so by default the
    two joins that fetch them are left out of the plan. Lines meet orders in a shuffled join;
    adaptive execution splits a receipt that holds many lines.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if names:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        clients = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        joined = joined.join(parts, joined.l_partkey == parts.p_partkey, "left").join(
            clients, joined.o_custkey == clients.c_custkey, "left"
        )

    channel = F.lit(DEFAULT_CHANNEL)
    for priority, name in CHANNEL_OF_PRIORITY.items():
        channel = F.when(F.col("o_orderpriority") == priority, name).otherwise(channel)
    discount = (
        F.when(F.col("l_partkey") % 53 == 0, F.lit(None).cast("double"))
        .when(F.col("l_partkey") % 211 == 0, F.lit(1.17))
        .otherwise(F.col("l_discount"))
    )
    birth = F.date_add(F.lit("1890-01-01").cast("date"), (F.col("o_custkey") * 7919 % 45000).cast("int"))
    columns = [
        F.timestamp_add("SECOND", (F.col("l_orderkey") * 7919 % 86400).cast("int"), F.col("o_orderdate")).alias("fecha"),
        channel.alias("canal"),
        F.col("l_partkey").cast("double").alias("sku"),
        F.when(F.col("l_partkey") % 307 == 0, 0.0).otherwise(F.col("l_quantity")).alias("unidades"),
        discount.alias("porcentaje_descuento"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("monto_aplicado"),
        F.col("l_orderkey").alias("boleta"),
        F.col("l_suppkey").cast("double").alias("local"),
        F.col("o_custkey").cast("string").alias("codigo_cliente"),
        F.when(F.col("o_custkey") % 97 != 0, birth).alias("fecha_nacimiento"),
        F.when(F.col("o_custkey") % 89 != 0, (1 + F.col("o_custkey") % 2).cast("double")).alias("genero"),
    ]
    if names:
        columns.insert(3, F.col("p_name").alias("producto"))
        columns.insert(10, F.col("c_name").alias("run_cliente"))
    return joined.select(*columns)
