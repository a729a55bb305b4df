"""Batch-by-batch outputs that may be written twice without harm, and the current state of windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsight.operators.reconcile import latest_per_key

WINDOW_KEY = ("experiment_id", "source_ip", "window_start")
VERSION = "stream_batch_id"


def batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:020d}"


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{batch_name(batch_id)}"


def with_batch_id(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn(VERSION, F.lit(batch_id).cast("bigint"))


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch owns its folder, so a repeated batch replaces its own output only."""
    with_batch_id(df, batch_id).write.mode("overwrite").parquet(batch_folder(path, batch_id))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(path)


@dataclass(frozen=True)
class StateTable:
    """The newest row of each key of a stream's batches, as a base and the batches since: a log that is compacted.

    A batch is written as a delta. After every ``every`` batches the base and the deltas are merged into
    a new base, and only then a commit names it. Bases, commits and deltas lie in a fixed number of
    folders that are used in turn, so neither reading nor the space on disk grows with the number
    of batches. The base that a commit names and the deltas after it are never overwritten before the next
    commit, so a crash at any point leaves a state that can be read, and the batch that is then
    repeated does the rest. One query writes a table. A reader that is slower than a whole
    compaction after its own may find its base replaced, and must read again.
    """

    path: str
    keys: Sequence[str] = WINDOW_KEY
    every: int = 32

    def delta_folder(self, batch_id: int) -> str:
        # three times as many as one merge takes: those merged last are not overwritten before the next merge
        return f"{self.path}/deltas/slot-{batch_id % (3 * self.every):05d}"

    def base_folder(self, number: int) -> str:
        return f"{self.path}/base-{number % 2}"

    def commits(self, spark: SparkSession) -> list[tuple[int, int]]:
        """``number, last_batch`` of the commits that can be read, the latest one last."""
        found = []
        for side in (0, 1):
            try:
                rows = spark.read.schema("number bigint, last_batch bigint").parquet(f"{self.path}/commit-{side}").collect()
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            # a folder whose writing was cut short has no row
            found += [(row.number, row.last_batch) for row in rows]
        return sorted(found)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Write a batch; the one that ends a round of ``every`` batches is merged with those before it."""
        with_batch_id(df, batch_id).write.mode("overwrite").parquet(self.delta_folder(batch_id))
        if (batch_id + 1) % self.every == 0:
            self.merge(df.sparkSession, batch_id)

    def merge(self, spark: SparkSession, last_batch: int) -> None:
        """Make a base of everything up to a batch, and commit it. Merging again what is merged changes nothing."""
        number, merged = (self.commits(spark) or [(-1, -1)])[-1]
        if last_batch <= merged:
            return
        current = self.read(spark).where(F.col(VERSION) <= last_batch)
        current.write.mode("overwrite").parquet(self.base_folder(number + 1))
        commit = spark.range(1).select(F.lit(number + 1).cast("bigint").alias("number"), F.lit(last_batch).cast("bigint").alias("last_batch"))
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commit-{(number + 1) % 2}")

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """The newest row of each key. Only keys of the deltas are aggregated; the rest of the base is taken as it is."""
        number, merged = (self.commits(spark) or [(-1, -1)])[-1]
        reader = spark.read.schema(schema) if schema else spark.read
        deltas = reader.option("recursiveFileLookup", True).parquet(f"{self.path}/deltas").where(F.col(VERSION) > merged)
        fresh = latest_per_key(deltas, list(self.keys), VERSION)
        if number < 0:
            return fresh
        base = spark.read.schema(deltas.schema).parquet(self.base_folder(number))
        changed = deltas.select(*self.keys).distinct()
        same = [base[key].eqNullSafe(changed[key]) for key in self.keys]
        return base.join(changed, same, "left_anti").unionByName(fresh)


def current_windows(batches: DataFrame) -> DataFrame:
    """The newest state of each window: later batches replace earlier ones."""
    return latest_per_key(batches, list(WINDOW_KEY), VERSION)


def newest_windows(windows: DataFrame, limit: int = 5_000) -> DataFrame:
    """The windows that started last, for a viewer."""
    return windows.orderBy(F.desc("window_start"), *WINDOW_KEY[:2]).limit(limit)


def batch_summary(df: DataFrame, *, batch_id: int, run_id: str, processed_at: str) -> DataFrame:
    """One row about a scored batch, also for an empty one."""
    zero = F.lit(0.0)
    n, alerts = F.count(F.lit(1)), F.count_if(F.col("prediction") == 1)
    return df.agg(
        n.alias("input_rows"),
        alerts.alias("alert_rows"),
        (n - alerts).alias("normal_rows"),
        F.coalesce(F.try_divide(alerts, n), zero).alias("alert_rate"),
        F.coalesce(F.max("attack_probability"), zero).alias("max_attack_probability"),
        F.coalesce(F.avg("attack_probability"), zero).alias("mean_attack_probability"),
        F.count_distinct("source_file").alias("source_file_count"),
    ).select(
        F.lit(batch_id).cast("bigint").alias("stream_batch_id"),
        F.lit(run_id).alias("query_run_id"),
        F.lit(processed_at).alias("processed_at"),
        "*",
    )
