"""Python work on a text column, with the other columns passed on as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Arrow types of the columns that operators add, by their names in a schema string.
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def with_texts(df: DataFrame, kept: list[str], column: str, added: dict[str, str | pa.DataType], work: Callable[[list], list[list]]) -> DataFrame:
    """``kept`` columns of ``df``, and the ``added`` ones (name to type) that ``work`` makes of a batch of ``column``.

    Kept columns go through Arrow untouched, so null and large ids stay what they are. Rows keep their
    number and order.
    """
    names = [*kept, *added]
    types = [_TYPES[t] if isinstance(t, str) else t for t in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch.column(column).to_pylist())
            arrays = [batch.column(c) for c in kept] + [pa.array(values, type=t) for values, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    ddl = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{c}` {t if isinstance(t, str) else _ddl(t)}" for c, t in added.items()]
    return df.select(*dict.fromkeys([*kept, column])).mapInArrow(run, ", ".join(ddl))


def _ddl(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_ddl(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{f.name}: {_ddl(f.type)}' for f in kind)}>"
    return next(name for name, t in _TYPES.items() if t == kind)
