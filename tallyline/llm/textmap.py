"""Columns computed from a text column by Python code, in bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Texts handled at once in a task; a single longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, cut so that the texts of a slice hold about ``limit`` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // limit
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(part)]):
            yield batch.slice(start, end - start)


def with_text_columns(
    df: DataFrame,
    text: str,
    schema: str,
    make: Callable[[], Callable[[Sequence[str | None]], list]],
) -> DataFrame:
    """``df`` with the columns of ``schema`` (a DDL text) computed from its column ``text``.

    ``make`` is called once per task and returns the function that turns a list of texts into one
    list or Arrow array per new column. A column of ``df`` that has the name of a new one is replaced.
    """
    added = T.StructType.fromDDL(schema)
    source = next(name for name in df.columns if name.lower() == text.lower())
    kept = [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in added.fieldNames()}]
    arrow = to_arrow_schema(T.StructType(kept + added.fields))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in slices(batches, source):
            columns = [part.column(name).cast(arrow.field(name).type) for name in names]
            values = compute(part.column(source).to_pylist())
            columns += [
                v if isinstance(v, pa.Array) else pa.array(v, type=arrow.field(len(names) + i).type)
                for i, v in enumerate(values)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, T.StructType(kept + added.fields))
