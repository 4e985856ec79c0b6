"""Order-dependent passes over arrays whose state neither windows nor lambdas can carry in linear time.

A row's array stays in its row: no shuffle.  One number an
element comes back from Python; what it means is worked out in expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: ``step(state, values)`` gives the next state and a number for the element; the state before the first is None.
Step = Callable[[object, tuple], tuple[object, int]]


def fold(step: Step, values: Iterable[tuple]) -> list[int]:
    """The numbers of a pass over one array."""
    state, out = None, []
    for v in values:
        state, n = step(state, v)
        out.append(n)
    return out


def _values(column: pa.Array) -> list:
    """Numbers as floats, null as NaN; texts as they are."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return column.to_pylist()
    return pc.fill_null(pc.cast(column, pa.float64()), np.nan).to_numpy(zero_copy_only=False).tolist()


def scanned(df: DataFrame, items: str, fields: list[str], step: Step, out: str) -> DataFrame:
    """``df`` with an array ``out`` of a number for each element of the array of structs ``items``.

    ``step`` sees the named fields as numbers, null as NaN, and texts as they
    are, null as None; a null array gives null.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.LongType()))])

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            column = batch.column(items)
            flat = pc.list_flatten(column)
            numbers = [_values(pc.struct_field(flat, f)) for f in fields]
            rows = zip(*numbers, strict=True) if fields else iter(())
            sizes = pc.list_value_length(column).to_pylist()
            made = [None if n is None else fold(step, [next(rows) for _ in range(n)]) for n in sizes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int64()))], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)
