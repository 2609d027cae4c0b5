"""Columns computed over Arrow batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def appended(df: DataFrame, inputs: list[str], more: str, start: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns of the DDL text ``more`` behind its own; the other columns pass through as they are.

    ``start()`` is called once a task and gives a function of the lists of ``inputs`` of a batch that
    returns a list for each column of ``more``.  Unlike a user-defined function in an expression, this step is never
    repeated or moved by a filter on its result.
    """
    added = StructType.fromDDL(more)
    if clash := {f.name.lower() for f in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    places, kinds = [df.columns.index(c) for c in inputs], [f.dataType.simpleString() for f in added]
    arrow = {"int": pa.int32(), "string": pa.string(), "bigint": pa.int64()}
    plain = [f"c{i}" for i in range(len(df.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            out = work(*[batch.column(i).to_pylist() for i in places])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, arrow[k]) for x, k in zip(out, kinds)]], names=[*plain, *added.names])

    schema = StructType()
    for name, field in zip(plain, df.schema.fields):
        schema.add(name, field.dataType)
    for field in added.fields:
        schema.add(field)
    return df.toDF(*plain).mapInArrow(run, schema).toDF(*df.columns, *added.names)
