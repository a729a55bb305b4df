"""Run a function over Arrow batches of chosen columns, whole texts and all rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The column types that the operators exchange with Python.
ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of ``"name type, name type"``."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def release_memory() -> None:
    """Give back to the system what Arrow and the C library keep for later; workers live on between the tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that fewer texts are Python objects at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()
    release_memory()


def map_batches(df: DataFrame, ddl: str, convert: Callable[[list[list]], dict[str, list]]) -> DataFrame:
    """``convert`` gets the columns of some rows as lists and gives the columns of the result."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict(convert([column.to_pylist() for column in part.columns]), schema=schema)

    return df.mapInArrow(run, ddl)


def filter_batches(df: DataFrame, text: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text ``keep`` accepts, with all their columns and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            for part in slices(batch):
                yield part.filter(pa.array(keep(part.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def required(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that other columns of any name cannot clash with the operator's own."""
    return df.select(*(df[name] for name in names))


def text_or_empty(df: DataFrame, name: str) -> Column:
    return F.coalesce(df[name], F.lit(""))
