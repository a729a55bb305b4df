"""Fitting, comparison and choice of classifiers."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.operators.evaluate import (
    THRESHOLDS,
    best_threshold,
    measure_at,
    positive_score,
    ranking_measures,
    threshold_curve,
)
from flowsight.operators.features import MANY_ROWS, dealt
from flowsight.session import written


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, rows, weight`` with weight = N / (2 n); both labels, and no other, must occur."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    sound = (F.col("n0") > 0) & (F.col("n1") > 0) & (F.col("n0") + F.col("n1") == F.col("n"))

    def entry(value: int):
        rows = F.when(sound, F.col(f"n{value}")).otherwise(F.raise_error(F.lit("labels 0 and 1 are both needed, and no other")))
        return F.struct(F.lit(value).alias("label"), rows.alias("rows"), (F.col("n") / (2.0 * rows)).alias("weight"))

    return counts.select(F.inline(F.array(entry(0), entry(1))))


def with_class_weights(
    df: DataFrame, weights: Mapping[int, float], *, label: str = "label", weight: str = "class_weight"
) -> DataFrame:
    """Attach the weights that were computed on the training rows."""
    if set(weights) != {0, 1} or min(weights.values()) <= 0:
        raise ValueError("positive weights for the labels 0 and 1 are needed")
    value = F.when(F.col(label) == 0, float(weights[0])).when(F.col(label) == 1, float(weights[1]))
    return df.withColumn(weight, value)


@dataclass(frozen=True)
class Candidate:
    """A named classifier, and whether it is fitted with class weights."""

    name: str
    family: str
    classifier: Estimator
    weighted: bool = False


@dataclass(frozen=True)
class Fitted:
    candidate: Candidate
    model: PipelineModel
    report: DataFrame
    curve: DataFrame


def model_details(model: Model) -> dict[str, float]:
    """Figures of a fitted logistic regression or forest; a loaded regression no longer knows its iterations."""
    if hasattr(model, "trees"):
        return {
            "trees": float(model.getNumTrees),
            "nodes": float(model.totalNumNodes),
            "used_features": float(model.featureImportances.numNonzeros()),
        }
    iterations = {"iterations": float(model.summary.totalIterations)} if model.hasSummary else {}
    return {
        **iterations,
        "coefficient_norm": float(model.coefficients.norm(2)),
        "nonzero_coefficients": float(model.coefficients.numNonzeros()),
        "intercept": float(model.intercept),
    }


def details_table(df: DataFrame, name: str, model: Model) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("detail"), F.lit(v).alias("value")) for k, v in model_details(model).items()]
    return df.sparkSession.range(1).select(F.lit(name).alias("name"), F.inline(F.array(*rows)))


def fit_candidate(
    candidate: Candidate, prepared: PipelineModel, train: DataFrame, validation: DataFrame, *,
    thresholds: Sequence[float] = THRESHOLDS, metric: str = "f1", label: str = "label",
) -> Fitted:
    """Fit on train, choose the threshold on validation; the report is one row.

    ``prepared`` are the fitted feature stages, which candidates share; ``train`` and ``validation``
    have been through them, and ``train`` has been spread, with class weights where a candidate takes
    them. The resulting model is those stages followed by the classifier. The ranking measures are
    NULL if the validation rows have one label only.
    """
    started = time.perf_counter()
    classifier = candidate.classifier.fit(train)
    model = PipelineModel(stages=[*prepared.stages, classifier])
    fitted = time.perf_counter()
    columns = [F.col(label).alias("label"), "rawPrediction", positive_score().alias("score")]
    scores = written(classifier.transform(validation).select(*columns), "validation-scores")
    if scores.count() != validation.count():
        raise ValueError(f"{candidate.name}: scoring changed the number of rows")
    predicted = time.perf_counter()
    curve = written(threshold_curve(scores, thresholds, score="score"), "threshold-curve")
    area = ranking_measures(scores).first()
    report = best_threshold(curve, metric).select(
        F.lit(candidate.name).alias("name"),
        F.lit(candidate.family).alias("family"),
        "*",
        F.lit(area.roc_auc).cast("double").alias("roc_auc"),
        F.lit(area.pr_auc).cast("double").alias("pr_auc"),
        F.lit(fitted - started).alias("fit_seconds"),
        F.lit(predicted - fitted).alias("predict_seconds"),
    )
    return Fitted(candidate, model, report, curve)


def fit_all(
    candidates: Sequence[Candidate], prepared: PipelineModel, train: DataFrame, validation: DataFrame, *, label: str = "label",
    at_once: int = 4, many: int = MANY_ROWS, **options,
) -> dict[str, Fitted]:
    """Every candidate by name, up to ``at_once`` of them fitted side by side, or one by one beyond ``many`` rows.

    The training rows are spread and kept once for all of them, and let go afterwards. Small stages of
    one fit leave cores idle that another can use; with ``spark.scheduler.mode`` FAIR, each has a pool of
    its own and an equal share. Large tables occupy all cores anyway, and the rows that several fits hold at a time
    would not fit the memory. The results do not depend on what runs beside them, but the times do.
    """
    spark = train.sparkSession
    if any(candidate.weighted for candidate in candidates):
        weights = {row.label: row.weight for row in class_weights(train, label).collect()}
        train = with_class_weights(train, weights, label=label)

    def fit(candidate: Candidate) -> Fitted:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", candidate.name)
        try:
            return fit_candidate(candidate, prepared, ready, validation, label=label, **options)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    beside = 1 if train.count() > many else max(1, min(at_once, len(candidates)))
    with dealt(train, many) as ready, ThreadPoolExecutor(beside) as pool:
        # each thread is tied to one of the JVM, and so to its pool
        started = [pool.submit(inheritable_thread_target(spark)(fit), candidate) for candidate in candidates]
        found = [future.result() for future in started]
    return {fitted.candidate.name: fitted for fitted in found}


def best_candidate(reports: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: metric, recall, lower false positive rate, faster prediction, faster fit, name."""
    return reports.orderBy(
        F.desc(metric), F.desc("recall"), "false_positive_rate", "predict_seconds", "fit_seconds", "name"
    ).limit(1)


def test_once(model: PipelineModel, test: DataFrame, threshold: float, path: str, *, label: str = "label") -> DataFrame:
    """Measure on the test rows and write the result to a path that must be new.

    The write-once table is the guard against choosing a model by its test result.
    """
    scored = model.transform(test).withColumn("score", positive_score())
    measured = measure_at(scored, threshold, score="score", label=label)
    measured.coalesce(1).write.mode("errorifexists").parquet(path)
    return test.sparkSession.read.parquet(path)
