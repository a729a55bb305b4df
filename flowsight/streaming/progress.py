"""Progress of a query as rows, and the checks of a restart."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowsight.streaming.sinks import batch_name

PROGRESS_SCHEMA = (
    "id string, runId string, batchId bigint, timestamp string, numInputRows bigint, durationMs map<string, bigint>, "
    "eventTime map<string, string>, stateOperators array<struct<numRowsTotal: bigint, numRowsUpdated: bigint, numRowsDroppedByWatermark: bigint>>"
)


class ProgressRecorder(StreamingQueryListener):
    """Writes every report of the queries of one name to a folder, while it is in force::

        with ProgressRecorder(spark, path, name) as recorder:
            run = start(...)
            run.awaitTermination()
            recorder.wait_for(run)

    A session keeps only its last reports in memory. Here each batch owns a folder below that of its
    query, so a report that comes again replaces itself, and a query that is started again from its
    checkpoint goes on in the same table. Reports come on a thread of their own, after the batch:
    ``wait_for`` returns when all of a run are written, and raises what kept one from being so.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.changed = threading.Condition()
        self.ended: set[str] = set()
        self.failure: Exception | None = None

    def __enter__(self) -> ProgressRecorder:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        if report.name != self.name:
            return
        try:
            row = self.spark.createDataFrame([(report.json,)], "report string").coalesce(1)
            row.write.mode("overwrite").text(f"{self.path}/query-{report.id}/{batch_name(report.batchId)}")
        except Exception as failure:  # a listener's own errors would only be logged
            self.failure = self.failure or failure

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for(self, run: StreamingQuery, seconds: float = 60) -> None:
        """Until all reports of the ended run are written."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(run.runId) in self.ended, seconds):
                raise TimeoutError(f"no end of {self.name} was reported in {seconds} s")
        if self.failure:
            raise self.failure


def report_rows(reports: DataFrame) -> DataFrame:
    """``batch_id, input_rows, duration_seconds, rows_per_second`` and more, one row per JSON ``report``.

    The rate is NULL for an empty batch.
    """
    parsed = reports.select(F.from_json("report", PROGRESS_SCHEMA).alias("p"))
    seconds = F.coalesce(F.col("p.durationMs")["triggerExecution"], F.lit(0)) / 1000.0
    rows = F.coalesce("p.numInputRows", F.lit(0))
    return parsed.select(
        F.col("p.id").alias("query_id"),
        F.col("p.runId").alias("run_id"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.timestamp").alias("timestamp"),
        rows.alias("input_rows"),
        seconds.alias("duration_seconds"),
        F.when((rows > 0) & (seconds > 0), F.try_divide(rows, seconds)).alias("rows_per_second"),
        F.col("p.eventTime")["watermark"].alias("watermark"),
        F.aggregate("p.stateOperators", F.lit(0).cast("bigint"), lambda n, s: n + s["numRowsTotal"]).alias("state_rows"),
        F.coalesce(
            F.aggregate(
                "p.stateOperators", F.lit(0).cast("bigint"), lambda n, s: n + F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0))
            ),
            F.lit(0),
        ).alias("late_rows"),
    )


def recorded_progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all reports that ``ProgressRecorder`` has written below the path, over all runs."""
    reports = spark.read.schema("value string").option("recursiveFileLookup", True).text(path)
    return report_rows(reports.withColumnRenamed("value", "report"))


def progress_rows(spark: SparkSession, progress: Iterable) -> DataFrame:
    """The rows of reports in memory, of which Spark keeps a bounded number."""
    reports = [(item.json if hasattr(item, "json") else json.dumps(item),) for item in progress]
    return report_rows(spark.createDataFrame(reports, "report string"))


def require_none_late(progress: DataFrame) -> None:
    """Fail if a batch has dropped rows behind the watermark, for a replay that must be complete."""
    late = progress.agg(F.sum("late_rows")).first()[0]
    if late:
        raise ValueError(f"{late} rows came behind the watermark and were dropped")


def throughput(progress: DataFrame, keep: int = 30) -> DataFrame:
    """The last batches with data, one row each."""
    busy = progress.where(F.col("rows_per_second").isNotNull()).dropDuplicates(["batch_id"])
    return busy.select("batch_id", "input_rows", "duration_seconds", "rows_per_second").orderBy(F.desc("batch_id")).limit(keep)


def restart_check(batches: DataFrame, identifier: str = "id") -> DataFrame:
    """``rows, distinct_ids, duplicate_ids, batches, consecutive`` over all batch outputs.

    Batch ids of a stateless query follow each other without a gap, across a restart as well.
    """
    ids = batches.groupBy(identifier).agg(F.count(F.lit(1)).alias("n"))
    totals = ids.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_ids"), F.count_if(F.col("n") > 1).alias("duplicate_ids")
    )
    spans = batches.agg(
        F.count_distinct("stream_batch_id").alias("batches"),
        (F.max("stream_batch_id") - F.min("stream_batch_id") + 1).alias("span"),
    ).select(F.struct("batches", (F.col("batches") == F.col("span")).alias("consecutive")))
    return totals.withColumn("_spans", spans.scalar()).select("rows", "distinct_ids", "duplicate_ids", "_spans.*")
