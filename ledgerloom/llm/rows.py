"""Columns computed from the texts of rows, next to whatever else the rows hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..session import ship_code
from .blocks import Block, text_blocks


def per_text_columns(
    docs: DataFrame, text: str, fields: str, compute: Callable[[Block], list[pa.Array]],
    carried: list[str] | None = None,
) -> DataFrame:
    """``carried`` columns of ``docs`` (all by default) and ``fields``, computed block by block.

    A column of ``docs`` with the name of a new field is replaced by it.  Row order within a
    partition and repeated rows are kept.
    """
    ship_code(docs.sparkSession)
    given = _parse_datatype_string(fields).fields
    new = [field.name for field in given]
    carried = [name for name in (docs.columns if carried is None else carried) if name not in new]
    names = list(dict.fromkeys([*carried, text]))
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))
    inner = rows.schema["row"].dataType
    at, kept = names.index(text), [names.index(name) for name in carried]
    outer = StructType([StructField("row", StructType([inner.fields[i] for i in kept]))])
    outer = StructType(outer.fields + given)
    labels = outer.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("row").flatten()
            for block in text_blocks(parts[at]):
                some = [parts[i].slice(block.first, block.n) for i in kept]
                struct = pa.StructArray.from_arrays(some, fields=[
                    pa.field(inner.fields[i].name, parts[i].type) for i in kept])
                yield pa.RecordBatch.from_arrays([struct, *compute(block)], labels)

    found = rows.mapInArrow(run, outer)
    return found.select(*[F.col("row")[name].alias(name) for name in carried], *new)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches as fewer of at least ``rows`` rows; the last may be smaller."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
