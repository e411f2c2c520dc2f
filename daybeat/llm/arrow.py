"""Helpers for functions that Spark runs over Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

# One output batch holds about this many bytes of text, whatever the number of rows.
BATCH_BYTES = 4 << 20


def find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver has it."""
    root = str(Path(__file__).parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))
    return spark


def pieces(batch: pa.RecordBatch, text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    start = size = 0
    for i, value in enumerate(column):
        size += len(value.as_buffer()) if value.is_valid else 0
        if size >= most:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def add_columns(df: DataFrame, text: str, fields: list[T.StructField],
                make: Callable[[list[bytes | None]], list[pa.Array]]) -> DataFrame:
    """``df`` with new columns that ``make`` derives from the UTF-8 bytes of ``text``.

    A column of ``df`` that has the name of a new one is replaced.
    """
    names = {f.name for f in fields}
    kept = df.select(*[df[f"`{c}`"] for c in df.columns if c not in names or c == text])
    schema = T.StructType([f for f in kept.schema.fields if f.name not in names] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                at = part.schema.get_field_index(text)
                values = part.column(at).cast(pa.binary()).to_pylist()
                old = [i for i, n in enumerate(part.schema.names) if n not in names]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in old] + make(values),
                                                 names=schema.names)

    return kept.mapInArrow(run, schema)
