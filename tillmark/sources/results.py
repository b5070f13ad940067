"""One tidy table of all results, and its JSON sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.sources.csv import union_all


def tidy(section: str, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(section, key1, key2, value)``: one row per result cell, ``key1`` joined from ``keys``."""
    values = [c for c in df.columns if c not in keys]
    key1 = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("")

    def text(name: str):
        kind = df.schema[name].dataType.typeName()
        column = F.to_json(name) if kind in ("map", "struct", "array") else F.col(name).cast("string")
        return column.alias(name)

    wide = df.select(key1.alias("key1"), *[text(c) for c in values])
    long = wide.unpivot(["key1"], values, "key2", "value")
    return long.select(F.lit(section).alias("section"), "key1", "key2", "value")


def results_table(results: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return union_all([tidy(section, df, keys) for section, (df, keys) in results.items()])


def _json_text(value: Column) -> Column:
    """A string as JSON text, quoted."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _object(entries: Column) -> Column:
    """JSON object text from an array of (name, JSON text), by name."""
    fields = F.transform(F.array_sort(entries), lambda e: F.concat(_json_text(e["name"]), F.lit(":"), e["json"]))
    return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))


def _section(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(name, json)``, one row: the object of a keyless result's row, else an object of its rows by key; null for no rows."""
    values = [c for c in df.columns if c not in keys]
    row = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    if not keys:
        return df.select(row.alias("json")).agg(F.first("json").alias("json")).select(F.lit(name).alias("name"), "json")
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    entries = df.select(F.struct(key.alias("name"), row.alias("json")).alias("entry")).agg(F.collect_list("entry").alias("entries"))
    return entries.select(F.lit(name).alias("name"), F.when(F.size("entries") > 0, _object(F.col("entries"))).alias("json"))


def results_document(results: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """All results as one nested JSON text, one row: sections by name, rows of a section by their keys, numbers as numbers.

    Results are small tables; each becomes text in its own task, and only texts of sections meet.
    """
    sections = union_all([_section(name, df, keys) for name, (df, keys) in results.items()])
    named = sections.select(F.struct("name", F.coalesce("json", F.lit("null")).alias("json")).alias("entry"))
    return named.agg(F.collect_list("entry").alias("entries")).select(_object(F.col("entries")).alias("document"))


def write_document(results: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str) -> None:
    """The nested document as one text file in the folder ``path``."""
    results_document(results).coalesce(1).write.text(path)


def write_results(results: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str) -> None:
    """One JSON object per result cell; a missing number is a null."""
    results_table(results).write.option("ignoreNullFields", False).json(path)
