"""Streaming jobs and their named queries, which read the given tables as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowsight.contract import FLOW
from flowsight.operators.ranges import ROWS
from flowsight.operators.score import load_locked
from flowsight.operators.windows import WINDOW_FEATURES, rule_score
from flowsight.plans import tables
from flowsight.plans.registry import DAY, query, rounded, zoneless
from flowsight.session import scratch_path, written
from flowsight.streaming import progress, queries, sinks, sources


def scoring_job(
    spark: SparkSession, *, input_path: str, output: str, checkpoint: str, lock_path: str, name: str, max_files: int = 1,
    schema: T.StructType = FLOW.schema,
) -> DataFrame:
    """Score everything that has arrived with a locked model; returns the progress rows of this run.

    Called again with the same checkpoint it goes on with the files that arrived since. The reports
    of all runs are kept below ``output``: ``progress.recorded_progress(spark, f"{output}/progress")``.
    """
    sources.check_paths(input=input_path, output=output, checkpoint=checkpoint)
    model, lock = load_locked(spark, lock_path)
    source = sources.parquet_stream(spark, input_path, schema, max_files=max_files)
    with progress.ProgressRecorder(spark, f"{output}/progress", name) as recorder:
        run = queries.start_scoring(
            source, queries.model_scorer(model, lock, name), output=output, checkpoint=checkpoint, name=name, run_id=name
        )
        run.awaitTermination()
        recorder.wait_for(run)
    return progress.recorded_progress(spark, f"{output}/progress").where(F.col("run_id") == str(run.runId))


def restart_job(
    spark: SparkSession, rows: DataFrame, folder: str, *, lock_path: str, name: str, first: int = 2, more: int = 1, size: int = 20,
    order: Sequence[str] = ("id", "label"), task_rows: int = ROWS,
) -> dict[str, DataFrame]:
    """Land batches of ``rows`` by rank, score them, land more, and go on from the checkpoint: all below ``folder``.

    The second run must read the new batches only and leave every row in the output once, in batches
    numbered without a gap; otherwise the job fails. A landed batch, which has a file for each ``task_rows`` rows, is
    one batch of the stream. Returns ``scores``, ``summaries``, the ``check`` of the
    restart, and the ``progress`` of both runs.
    """
    paths = {"input_path": f"{folder}/landed", "output": f"{folder}/output", "checkpoint": f"{folder}/checkpoint"}
    identifier = order[0]
    landed = 0
    for turn, batches in enumerate((first, more)):
        for index in range(landed, landed + batches):
            sources.land_batch(rows, paths["input_path"], index, size, order=order, task_rows=task_rows)
        landed += batches
        run = scoring_job(
            spark, lock_path=lock_path, name=f"{name}-{turn}", schema=rows.schema, max_files=sources.batch_files(size, task_rows), **paths
        )
        read = run.agg(F.sum("input_rows")).first()[0]
        if read != batches * size:
            raise ValueError(f"run {turn} of {name} read {read} rows, {batches * size} had been landed")
    scores = sinks.read_batches(spark, f"{paths['output']}/predictions")
    check = written(progress.restart_check(scores, identifier), "restart-check")
    found = check.first()
    if found.rows != landed * size or found.duplicate_ids or found.batches != landed or not found.consecutive:
        raise ValueError(f"after the restart of {name}: {found.asDict()}")
    return {
        "scores": scores, "check": check, "summaries": sinks.read_batches(spark, f"{paths['output']}/summaries"),
        "progress": progress.recorded_progress(spark, f"{paths['output']}/progress"),
    }


def window_stream_job(
    spark: SparkSession,
    *,
    input_path: str,
    output: str,
    checkpoint: str,
    model: PipelineModel,
    threshold: float,
    name: str,
    seconds: int | None = None,
) -> StreamingQuery:
    """Score the windows of the live flows as they change; returns the running query."""
    sources.check_paths(input=input_path, output=output, checkpoint=checkpoint)
    flows = sources.event_stream(spark, input_path)
    scorer = queries.window_scorer(model, threshold)
    return queries.start_windows(flows, scorer, output=output, checkpoint=checkpoint, name=name, seconds=seconds)


# --- named queries ---------------------------------------------------------------------------


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table as a stream, whether it is one file or a folder of part files.

    The path is a pattern that only the exact name fits, since a stream takes no plain file path.
    """
    return sources.parquet_stream(spark, f"{folder}/[{name[0]}]{name[1:]}.parquet", tables.SCHEMAS[name], max_files=50)


def disorder_seconds(spark: SparkSession, folder: str, name: str, column: str) -> int:
    """Seconds between a stored table's first and last time: no row can be later than that in a replay."""
    times = F.col(column).cast("timestamp").cast("bigint")
    first, last = tables.table(spark, folder, name).agg(F.min(times), F.max(times)).first()
    return last - first + 1 if first is not None else 1


def score_events(spark: SparkSession, folder: str) -> str:
    """Score the event table as a stream by its value; returns the output folder."""
    path = scratch_path(spark, "event-scores")

    def scorer(batch: DataFrame) -> DataFrame:
        return tables.as_scored_events(batch, "source_file")

    source = table_stream(spark, folder, "events")
    run = queries.start_scoring(
        source, scorer, output=f"{path}/output", checkpoint=f"{path}/checkpoint", name=f"scores-{path[-32:]}", run_id="run"
    )
    run.awaitTermination()
    return f"{path}/output"


@query
def stream_scores(spark, folder):
    stored = sinks.read_batches(spark, f"{score_events(spark, folder)}/predictions")
    return stored.drop("processed_at", "stream_batch_id", "source_file")


@query
def stream_summary(spark, folder):
    """The batch summaries added up; how files fall into batches does not matter."""
    output = score_events(spark, folder)
    stored = sinks.read_batches(spark, f"{output}/summaries")
    totals = stored.agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("alert_rows").alias("alert_rows"),
        F.sum("normal_rows").alias("normal_rows"),
        F.max("max_attack_probability").alias("max_attack_probability"),
        (F.sum(F.col("alert_rate") * F.col("input_rows")) / F.sum("input_rows")).alias("alert_rate"),
        (F.sum(F.col("mean_attack_probability") * F.col("input_rows")) / F.sum("input_rows")).alias("mean_attack_probability"),
    )
    read = sinks.read_batches(spark, f"{output}/predictions").groupBy("stream_batch_id").agg(
        F.count_distinct("source_file").alias("files")
    )
    files = stored.join(read, "stream_batch_id", "left").select(F.col("source_file_count") == F.coalesce("files", F.lit(0)))
    return rounded(totals.withColumn("files_counted", files.agg(F.bool_and(files.columns[0])).scalar()))


LANDINGS = 3


@query
def stream_restart_check(spark, folder):
    """All events land in three parts by a hash, and one query is stopped and started again between them.

    Started again it must be the same query in a new run, read only what has arrived since, and
    leave every event in the output once.
    """
    path = scratch_path(spark, "event-restarts")
    rows = tables.table(spark, folder, "events").withColumn("_part", F.pmod(F.xxhash64("event_id"), F.lit(LANDINGS)))
    runs, only_new = [], True
    for part in range(LANDINGS):
        landed = rows.where(F.col("_part") == part).drop("_part")
        landed.write.mode("errorifexists").parquet(f"{path}/landed/part-{part}")
        source = sources.parquet_stream(spark, f"{path}/landed", tables.SCHEMAS["events"], max_files=50)
        run = queries.start_scoring(
            source, lambda batch: tables.as_scored_events(batch, "source_file"), output=f"{path}/output",
            checkpoint=f"{path}/checkpoint", name=f"restart-{path[-32:]}", run_id=f"run-{part}",
        )
        run.awaitTermination()
        runs.append(run)
        summaries = sinks.read_batches(spark, f"{path}/output/summaries").where(F.col("query_run_id") == f"run-{part}")
        read = summaries.agg(F.coalesce(F.sum("input_rows"), F.lit(0))).first()[0]
        only_new = only_new and read == spark.read.parquet(f"{path}/landed/part-{part}").count()
    same, new = len({run.id for run in runs}) == 1, len({run.runId for run in runs}) == LANDINGS
    checked = progress.restart_check(sinks.read_batches(spark, f"{path}/output/predictions")).drop("batches")
    return checked.withColumns({"same_query": F.lit(same), "new_runs": F.lit(new), "only_new_rows": F.lit(only_new)})


@query
def stream_windows(spark, folder):
    """Window features kept by a stream, scored by the rule: the newest state of every window.

    A stored table is replayed whole, so the watermark covers its whole span.
    """
    path = scratch_path(spark, "event-windows")

    def scorer(windows: DataFrame) -> DataFrame:
        return rule_score(windows).withColumn("prediction", (F.col("rule_score") >= 0.5).cast("int"))

    flows = tables.as_flow_events(table_stream(spark, folder, "events")).where(F.col("record_type") == "flow")
    name = f"windows-{path[-32:]}"
    with progress.ProgressRecorder(spark, f"{path}/progress", name) as recorder:
        run = queries.start_windows(
            flows, scorer, output=f"{path}/output", checkpoint=f"{path}/checkpoint", name=name, window_seconds=DAY,
            watermark_seconds=disorder_seconds(spark, folder, "events", "ts"),
        )
        run.awaitTermination()
        recorder.wait_for(run)
    progress.require_none_late(progress.recorded_progress(spark, f"{path}/progress"))
    current = sinks.StateTable(f"{path}/output").read(spark)
    columns = ["experiment_id", "source_ip", "actor_id", "window_start", "window_end", *WINDOW_FEATURES, "prediction"]
    return zoneless(rounded(current.select(*columns)))

