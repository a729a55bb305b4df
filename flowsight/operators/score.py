"""Scoring with a fitted model: decisions at a locked threshold, model locks, batch output."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.operators.evaluate import positive_score
from flowsight.sources.manifest import folder_digest
from flowsight.sources.sinks import write_checked, write_csv_report

# Columns that describe a scored row, in output order.
DESCRIPTIVE = ("id", "proto", "service", "state", "attack_cat", "label", "source_file")

# Rows of a CSV part.
CSV_ROWS = 250_000


def with_optional_columns(df: DataFrame, **types: str) -> DataFrame:
    """Add the named columns as typed NULL where they are absent."""
    absent = {name: F.lit(None).cast(kind) for name, kind in types.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def decide(df: DataFrame, threshold: float, *, score: str = "attack_probability", probability: str = "probability") -> DataFrame:
    """Add the positive-class probability, and the decision ``prediction`` at the threshold."""
    return df.withColumn(score, positive_score(probability)).withColumn(
        "prediction", (F.col(score) >= float(threshold)).cast("int")
    )


def scored_rows(
    transformed: DataFrame, *, threshold: float, run_id: str, scored_at: str, model_name: str, model_sha256: str
) -> tuple[DataFrame, DataFrame]:
    """All columns with the decision, and the flat output table with the run's particulars.

    The model's own decision stays as ``model_prediction_at_0_5``. Without labels the actual
    class and the correctness are NULL.
    """
    kept = with_optional_columns(
        transformed.withColumn("model_prediction_at_0_5", F.col("prediction").cast("int")), label="int", attack_cat="string"
    )
    truth, guess = F.col("label"), F.col("prediction")
    rich = decide(kept, threshold).withColumns(
        {
            "predicted_class": F.when(guess == 1, "Attack").otherwise("Normal"),
            "actual_class": F.when(truth == 1, "Attack").when(truth == 0, "Normal"),
            "is_correct": guess == truth,
        }
    )
    run = {
        "run_id": F.lit(run_id),
        "scored_at": F.lit(scored_at),
        "model_name": F.lit(model_name),
        "model_sha256": F.lit(model_sha256),
        "decision_threshold": F.lit(float(threshold)),
    }
    flat = rich.select(
        *[value.alias(name) for name, value in run.items()],
        *[name for name in DESCRIPTIVE if name in rich.columns],
        "attack_probability", "model_prediction_at_0_5", "prediction", "predicted_class", "actual_class", "is_correct",
    )
    return rich, flat


@dataclass(frozen=True)
class ModelLock:
    """What a saved model must still be when it is used."""

    model_name: str
    decision_threshold: float
    model_sha256: str
    stages: tuple[str, ...]


def stage_names(model: PipelineModel) -> tuple[str, ...]:
    return tuple(type(stage).__name__ for stage in model.stages)


def lock_model(spark: SparkSession, model: PipelineModel, path: str, *, name: str, threshold: float) -> ModelLock:
    """Save the model below ``path`` with a one-row table of its digest, stages and threshold."""
    model.write().overwrite().save(f"{path}/model")
    lock = ModelLock(name, float(threshold), folder_digest(spark, f"{path}/model"), stage_names(model))
    record = spark.range(1).select(F.lit(json.dumps(asdict(lock))).alias("value"))
    record.coalesce(1).write.mode("overwrite").text(f"{path}/lock")
    return lock


def load_locked(spark: SparkSession, path: str) -> tuple[PipelineModel, ModelLock]:
    """Load a locked model; refuse one whose files or stages have changed."""
    record = json.loads(spark.read.text(f"{path}/lock").first().value)
    lock = ModelLock(**{**record, "stages": tuple(record["stages"])})
    if folder_digest(spark, f"{path}/model") != lock.model_sha256:
        raise ValueError("the saved model does not match its lock")
    model = PipelineModel.load(f"{path}/model")
    if stage_names(model) != lock.stages:
        raise ValueError("the stages of the saved model do not match its lock")
    return model, lock


def score_batch(
    df: DataFrame, model: PipelineModel, lock: ModelLock, path: str, *, run_id: str, scored_at: str, csv: bool = False
) -> DataFrame:
    """Score a table into Parquet, checked by reading it back; no row may be lost.

    ``csv`` adds a copy as CSV, one part for about each ``CSV_ROWS`` rows. The Parquet
    path must be new, which is also what keeps a final test from being scored twice.
    """
    particulars = dict(threshold=lock.decision_threshold, run_id=run_id, scored_at=scored_at)
    _, flat = scored_rows(
        model.transform(df), model_name=lock.model_name, model_sha256=lock.model_sha256, **particulars
    )
    rows = df.count()
    saved = write_checked(flat, f"{path}/parquet", expected_rows=rows)
    if csv:
        write_csv_report(saved, f"{path}/csv", parts=max(1, -(-rows // CSV_ROWS)))
    return saved
