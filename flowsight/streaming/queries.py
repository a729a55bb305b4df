"""Streaming queries: stateless scoring, and windows that are scored as they change."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from flowsight.operators.score import ModelLock, decide, scored_rows
from flowsight.operators.windows import (
    WATERMARK_SECONDS,
    WINDOW_FEATURES,
    WINDOW_SECONDS,
    event_time,
    window_features,
)
from flowsight.streaming.sinks import StateTable, batch_folder, batch_summary, write_batch

NAME_PATTERN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]{0,79}")
Scorer = Callable[[DataFrame], DataFrame]


def require_name(name: str) -> str:
    if not NAME_PATTERN.fullmatch(name):
        raise ValueError(f"query name not usable: {name!r}")
    return name


def with_trigger(writer: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """Everything available and then stop, or every ``seconds``."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    if seconds < 1:
        raise ValueError("the trigger interval must be at least 1 second")
    return writer.trigger(processingTime=f"{seconds} seconds")


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def utc_text(moment: str):
    """ISO text of a timestamp column in UTC; the session's time zone must be UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def start_scoring(
    source: DataFrame, score: Scorer, *, output: str, checkpoint: str, name: str, run_id: str, seconds: int | None = None
) -> StreamingQuery:
    """Stateless scoring: ``score`` adds ``attack_probability`` and ``prediction`` to each batch.

    Each batch writes its rows to its folder, then its one-row summary from those rows.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        processed_at = utc_now()
        rows = score(batch).withColumn("processed_at", F.lit(processed_at))
        write_batch(rows, f"{output}/predictions", batch_id)
        stored = batch.sparkSession.read.schema(rows.schema).parquet(batch_folder(f"{output}/predictions", batch_id))
        summary = batch_summary(stored, batch_id=batch_id, run_id=run_id, processed_at=processed_at)
        write_batch(summary.coalesce(1), f"{output}/summaries", batch_id)

    writer = source.writeStream.queryName(require_name(name)).foreachBatch(process).option("checkpointLocation", checkpoint)
    return with_trigger(writer, seconds).start()


def model_scorer(model: PipelineModel, lock: ModelLock, run_id: str) -> Scorer:
    """The flat scored output of a locked model, batch by batch."""

    def score(batch: DataFrame) -> DataFrame:
        particulars = dict(run_id=run_id, scored_at=utc_now(), model_name=lock.model_name, model_sha256=lock.model_sha256)
        return scored_rows(model.transform(batch), threshold=lock.decision_threshold, **particulars)[1]

    return score


def window_scorer(model: PipelineModel, threshold: float) -> Scorer:
    def score(windows: DataFrame) -> DataFrame:
        columns = ["experiment_id", "source_ip", "actor_id", "window_start", "window_end", *WINDOW_FEATURES]
        return decide(model.transform(windows), threshold).select(*columns, "attack_probability", "prediction")

    return score


def start_windows(
    flows: DataFrame,
    score: Scorer,
    *,
    output: str,
    checkpoint: str,
    name: str,
    seconds: int | None = None,
    window_seconds: int = WINDOW_SECONDS,
    watermark_seconds: int = WATERMARK_SECONDS,
    unique_events: bool = False,
    merge_every: int = 32,
) -> StreamingQuery:
    """Window features kept in state; every batch writes the windows that changed, scored, to a ``StateTable``.

    Events behind the watermark are dropped, other late events emit their window again.
    ``unique_events`` also drops repeated event ids within the watermark.
    """
    if unique_events:
        timed = flows.withColumn("timestamp", event_time(flows)).where(F.col("timestamp").isNotNull())
        unique = timed.withWatermark("timestamp", f"{watermark_seconds} seconds").dropDuplicatesWithinWatermark(["event_id"])
        windows = window_features(unique, seconds=window_seconds, watermark_seconds=None)
    else:
        windows = window_features(flows, seconds=window_seconds, watermark_seconds=watermark_seconds)

    state = StateTable(output, every=merge_every)

    def process(batch: DataFrame, batch_id: int) -> None:
        state.write(score(batch), batch_id)

    writer = windows.writeStream.queryName(require_name(name)).outputMode("update").foreachBatch(process)
    return with_trigger(writer.option("checkpointLocation", checkpoint), seconds).start()
