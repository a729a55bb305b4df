"""Session builder and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # fits that run side by side share the cores
    "spark.scheduler.mode": "FAIR",
    # window state of many sources does not fit the heap of the executors
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app_name: str = "flowsight",
    *,
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time and adaptive execution; ``settings`` win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"flowsight-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder of the cluster.

    The folder is named by ``spark.checkpoint.dir``. Only a local session without that setting
    falls back to a temporary folder, since executors elsewhere could not read it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
        base = local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably, and lets the optimizer see the real size of the table: a join
    with it is broadcast only when the files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The rows computed once and held in the memory and on the disks of the executors, until the block ends.

    What is lost with an executor is computed again. Nothing that is read after the block may depend on it.
    """
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist(blocking=True)


def spread(df: DataFrame, divisor: int = 16) -> DataFrame:
    """The rows in an order and in partitions that follow from the rows alone.

    Forests draw their samples per partition, and sums of doubles depend on the order, so a fit on
    such a table does not change with the cores of the cluster or the layout of the files. There
    are about square root of rows / ``divisor`` partitions: their number and their size grow alike
    (44 for 500,000 rows, 20,000 for 100 billion). ``df`` is counted and shuffled once, so it should
    be a written table; its columns must not be maps.
    """
    place = F.xxhash64(*df.columns)
    return df.repartition(math.isqrt(df.count()) // divisor + 1, place).sortWithinPartitions(place)
