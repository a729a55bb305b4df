"""Streaming readers and the landing of new input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowsight.contract import FLOW, FLOW_EVENT_SCHEMA
from flowsight.operators.ranges import ROWS, rank_slice
from flowsight.operators.windows import recorded_flows
from flowsight.session import kept
from flowsight.sources.readers import with_file_name


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType = FLOW.schema, *, max_files: int = 1, pattern: str | None = None
) -> DataFrame:
    """New Parquet files below ``path``, at most ``max_files`` per batch, with their file name."""
    if max_files < 1:
        raise ValueError("max_files must be at least 1")
    reader = spark.readStream.schema(schema).options(maxFilesPerTrigger=max_files, recursiveFileLookup=True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return with_file_name(reader.parquet(path))


def event_stream(
    spark: SparkSession, path: str, schema: T.StructType = FLOW_EVENT_SCHEMA, *, max_files: int = 50, mode: str = "live"
) -> DataFrame:
    """Recorded flows of a mode from JSON lines."""
    return recorded_flows(spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path), mode)


def check_paths(**paths: str) -> None:
    """Input, outputs and checkpoint of a query must not lie inside one another."""
    names = list(paths)
    for place, left in enumerate(names):
        for right in names[place + 1 :]:
            one, two = (f"{paths[name].rstrip('/')}/" for name in (left, right))
            if one.startswith(two) or two.startswith(one):
                raise ValueError(f"{left} and {right} overlap")


def batch_files(size: int, task_rows: int = ROWS) -> int:
    """The files of a landed batch: one for each ``task_rows`` rows."""
    return max(1, -(-size // task_rows))


def land_batch(
    rows: DataFrame, path: str, index: int, size: int, *, order: Sequence[str] = ("id", "label"), task_rows: int = ROWS
) -> int:
    """Write rows ``size * index + 1 ... size * (index + 1)`` in order as the folder of one batch.

    The slice is found by ranks, so a late batch costs what the first one does, and no task orders more
    than ``task_rows`` rows (``ranges.rank_slice``); ``rows`` should be a written table. A batch is
    ``batch_files`` files. They appear when the write commits; a batch that exists or falls short is refused.
    """
    batch = rank_slice(rows, order, size * index, size * (index + 1), rows=task_rows)
    # dealt evenly, so no file is missing; the tasks that find the rows are as many as the table has
    with kept(batch.repartition(batch_files(size, task_rows))) as held:
        found = held.count()
        if found != size:
            raise ValueError(f"batch {index} has {found} of {size} rows")
        held.write.mode("errorifexists").parquet(f"{path}/batch-{index:05d}")
    return size
