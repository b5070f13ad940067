"""Column expressions and small helpers that the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: the space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: Anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that may be broadcast; a larger side is joined by a shuffle or taken in blocks.
BROADCAST_ROWS = 200_000


def whole(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def pieces(text: Column, separator: str) -> Column:
    """Non-empty parts of ``text`` between separators. Extracting matches would copy the text for each match."""
    return F.array_remove(F.split(text, separator, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; it should be a checkpointed or tiny frame."""
    return F.broadcast(df) if df.count() <= rows else df
