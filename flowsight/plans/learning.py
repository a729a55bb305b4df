"""Jobs that train, compare and lock classifiers, and their named queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.contract import FLOW, Contract
from flowsight.functions.hashing import portable_bucket
from flowsight.operators import evaluate, features, score, split, train, windows
from flowsight.operators.sample import seeded_sample
from flowsight.plans import tables
from flowsight.plans.registry import DAY, query
from flowsight.session import scratch_path, spread, written
from flowsight.sources.readers import union_all


@dataclass(frozen=True)
class Trained:
    """A fitted model with the threshold chosen on validation, and its measures per part."""

    model: PipelineModel
    threshold: float
    measures: DataFrame


def fit_and_test(
    pipeline: Pipeline,
    parts: Mapping[str, DataFrame],
    *,
    thresholds: Sequence[float] = evaluate.WINDOW_THRESHOLDS,
    choose=evaluate.best_threshold,
    baseline: str | None = None,
    label: str = "label",
) -> Trained:
    """Fit on ``train``, choose the threshold on ``validation``, measure on ``test``.

    ``baseline`` names a score column of the test rows that is measured beside the model.
    """
    model = pipeline.fit(spread(parts["train"]))
    chosen = choose(evaluate.threshold_curve(model.transform(parts["validation"]), thresholds, label=label))
    chosen = written(chosen, "chosen-threshold")
    threshold = chosen.first().threshold
    rows = [
        chosen.select(F.lit("validation").alias("part"), "*"),
        evaluate.measure_at(model.transform(parts["test"]), threshold, label=label).select(F.lit("test").alias("part"), "*"),
    ]
    if baseline:
        measured = evaluate.measure_at(parts["test"], 0.5, score=baseline, label=label)
        rows.append(measured.select(F.lit("baseline").alias("part"), "*"))
    return Trained(model, threshold, union_all(rows))


def compare_candidates(
    candidates: Sequence[train.Candidate], training: DataFrame, validation: DataFrame, contract: Contract = FLOW, *,
    thresholds: Sequence[float] = evaluate.THRESHOLDS, metric: str = "f1", stored: bool = False,
) -> tuple[train.Fitted, DataFrame]:
    """Fit every candidate on the same rows; the winner, and one row per candidate.

    The feature stages do not depend on the classifier: they are fitted once. Their vectors are written once for several
    candidates; a single one has them dealt out as they are made. Training rows are written first unless they are ``stored``.
    """
    training = training if stored else written(training, "training")
    prepared = features.fit_features(training, contract)
    columns = [contract.label, "features"]
    training, validation = (prepared.transform(rows).select(*columns) for rows in (training, validation))
    if len(candidates) > 1:
        training, validation = written(training, "training-features"), written(validation, "validation-features")
    options = dict(thresholds=thresholds, metric=metric, label=contract.label)
    fitted = train.fit_all(candidates, prepared, training, validation, **options)
    reports = written(union_all([f.report for f in fitted.values()]), "candidates")
    return fitted[train.best_candidate(reports, metric).first().name], reports


def default_candidates(label: str = "label") -> list[train.Candidate]:
    """Plain and weighted logistic regression, and two forests."""
    return [
        train.Candidate("logistic_unweighted", "logistic", features.logistic(label=label)),
        train.Candidate("logistic_balanced", "logistic", features.logistic(label=label, weight="class_weight"), weighted=True),
        train.Candidate("forest_depth8", "forest", features.forest(30, 8, label=label)),
        train.Candidate("forest_depth12", "forest", features.forest(50, 12, label=label)),
    ]


def disjoint_parts(rows: DataFrame, contract: Contract, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    training, validation = split.holdout_split(rows, contract.identifier, fraction=fraction, seed=seed)
    split.require_disjoint(training, validation, contract.identifier)
    return training, validation


def baseline_job(rows: DataFrame, contract: Contract = FLOW, *, fraction: float = 0.2, seed: int = 42) -> train.Fitted:
    """The logistic baseline with its threshold, on a split that is checked to be disjoint."""
    training, validation = disjoint_parts(rows, contract, fraction, seed)
    return compare_candidates(default_candidates(contract.label)[:1], training, validation, contract)[0]


def comparison_job(
    rows: DataFrame,
    path: str,
    contract: Contract = FLOW,
    *,
    candidates: Sequence[train.Candidate] | None = None,
    fraction: float = 0.2,
    seed: int = 42,
) -> tuple[score.ModelLock, DataFrame]:
    """Compare the candidates, then save and lock the winner with its threshold."""
    training, validation = disjoint_parts(rows, contract, fraction, seed)
    winner, reports = compare_candidates(candidates or default_candidates(contract.label), training, validation, contract)
    threshold = winner.report.first().threshold
    lock = score.lock_model(rows.sparkSession, winner.model, path, name=winner.candidate.name, threshold=threshold)
    return lock, reports


def lock_winner(
    fitted: train.Fitted, reports: DataFrame, path: str, *, name: str, threshold: float, trees: int | None = None
) -> score.ModelLock:
    """Lock a model whose name, threshold and number of trees were stated beforehand.

    They must be those of the best candidate of the reports and of the model itself.
    """
    best = train.best_candidate(reports).first()
    found = {"candidate": best.name, "model": fitted.candidate.name, "threshold": best.threshold}
    stated = {"candidate": name, "model": name, "threshold": float(threshold)}
    if trees is not None:
        found["trees"], stated["trees"] = train.model_details(fitted.model.stages[-1]).get("trees"), float(trees)
    differing = [key for key in stated if stated[key] != found[key]]
    if differing:
        raise ValueError(f"not the selected model: {', '.join(differing)} differ from {found}")
    return score.lock_model(reports.sparkSession, fitted.model, path, name=name, threshold=threshold)


def full_training_job(
    parts: DataFrame, path: str, contract: Contract = FLOW, *, max_iter: int = 25
) -> tuple[score.ModelLock, DataFrame, DataFrame]:
    """Fit on the saved train part, lock the threshold on validation, score the test part once.

    Returns the lock, the scored test rows and their measures.
    """
    spark = parts.sparkSession
    part = {name: parts.where(F.col("split") == name) for name in split.PARTS}
    candidate = train.Candidate("logistic", "logistic", features.logistic(label=contract.label, max_iter=max_iter))
    fitted, _ = compare_candidates([candidate], part["train"], part["validation"], contract, stored=True)
    threshold = fitted.report.first().threshold
    lock = score.lock_model(spark, fitted.model, f"{path}/locked", name="logistic", threshold=threshold)
    scored = score.decide(fitted.model.transform(part["test"]), threshold, score="attack_score")
    wanted = "id source_file attack_cat label prediction attack_score proto service".split()
    scored.select(*[c for c in wanted if c in scored.columns]).write.mode("errorifexists").parquet(f"{path}/test")
    stored = spark.read.parquet(f"{path}/test")
    measures = evaluate.with_ratios(evaluate.confusion(stored))
    if measures.first().total != part["test"].count():
        raise ValueError("the confusion counts do not cover the test rows")
    return lock, stored, measures


def session_job(flows: DataFrame, truth: DataFrame, *, trees: int = 40, depth: int = 5) -> Trained:
    """The session classifier; other complete runs are measured as a challenge if there are any."""
    sessions = written(windows.complete_sessions(flows, truth), "sessions")
    mode = split.training_mode(sessions).first().training_mode
    parted = written(split.run_split(sessions.where(F.col("lab_mode") == mode).drop("lab_mode")), "session-split")
    parts = {name: parted.where(F.col("split") == name).drop("split") for name in split.PARTS}
    trained = fit_and_test(features.session_model(trees=trees, depth=depth), parts, choose=evaluate.most_sensitive_threshold)
    if mode != "calibration":
        return trained
    challenge = evaluate.challenge_measures(trained.model.transform(sessions), trained.threshold).drop("source_mode")
    measures = trained.measures.unionByName(challenge.select(F.lit("challenge").alias("part"), "*"))
    return Trained(trained.model, trained.threshold, measures)


def challenge_audit(model: PipelineModel, sessions: DataFrame, threshold: float) -> DataFrame:
    """Measure a saved session model on the training-mode runs it was not fitted on."""
    measured = evaluate.challenge_measures(model.transform(sessions), threshold)
    if measured.isEmpty():
        raise ValueError("there are no complete training-mode runs")
    return measured


def window_job(
    parts: Mapping[str, DataFrame], experiments: Mapping[str, str], *, least: int = 5, trees: int = 30, depth: int = 5
) -> Trained:
    """The window classifier on labelled windows of three experiments, beside the rule."""
    stored = {name: written(df, f"windows-{name}") for name, df in parts.items()}
    marked = union_all([df.select(F.lit(name).alias("split"), "label") for name, df in stored.items()])
    counts = marked.groupBy("split", "label").agg(F.count(F.lit(1)).alias("windows"))
    short = split.experiment_check(experiments, counts, least=least).where(~F.col("enough")).collect()
    if short:
        raise ValueError("too few labelled windows: " + ", ".join(f"{r.split} {r.label} {r.windows}" for r in short))
    stored["test"] = windows.rule_score(stored["test"])
    return fit_and_test(features.window_model(trees=trees, depth=depth), stored, baseline="rule_score")


def experiments_job(labelled: DataFrame, experiments: Mapping[str, str], **options) -> Trained:
    """``window_job`` on one table of labelled windows, of which each part is an experiment of its own."""
    parts = {part: windows.of_experiment(labelled, name) for part, name in experiments.items()}
    return window_job(parts, experiments, **options)


def flow_job(
    rows: DataFrame, test: DataFrame, *, fraction: float = 0.2, seed: int = 42, trees: int = 20, depth: int = 6
) -> Trained:
    """The classifier of single flows; the threshold is chosen on held-out rows and tested on the designated ones."""
    training, validation = split.holdout_split(rows, "id", fraction=fraction, seed=seed)
    parts = {"train": training, "validation": validation, "test": test}
    hashed = features.wide_columns(training, features.FLOW_TEXTS)
    return fit_and_test(features.flow_model(trees=trees, depth=depth, hashed=hashed), parts, thresholds=evaluate.THRESHOLDS)


@dataclass(frozen=True)
class SavedModel:
    """A classifier of live traffic with its measures, and the lock that it was saved under."""

    trained: Trained
    lock: score.ModelLock


def lab_job(
    rows: DataFrame, test: DataFrame, flows: DataFrame, truth: DataFrame, path: str, *, seed: int = 42
) -> dict[str, SavedModel]:
    """The classifier of single flows and that of sessions, trained in one job and saved below ``path``.

    Each is locked with the threshold chosen on its validation rows. The folder must be new. The measures are
    stored beside the models.
    """
    spark = rows.sparkSession
    trained = {"flow": flow_job(rows, test, seed=seed), "session": session_job(flows, truth)}
    saved = {}
    for name, found in trained.items():
        found.measures.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{name}/measures")
        lock = score.lock_model(spark, found.model, f"{path}/{name}", name=f"{name}_forest", threshold=found.threshold)
        measures = spark.read.parquet(f"{path}/{name}/measures")
        saved[name] = SavedModel(Trained(found.model, found.threshold, measures), lock)
    return saved


def sampled_job(
    rows: DataFrame, contract: Contract = FLOW, *, train_rows: int = 12_000, seed: int = 42, bucket: split.Bucket = split.hash_bucket
) -> train.Fitted:
    """A small forest fitted on a label-balanced sample of ``train_rows``, measured on all validation rows."""
    training, validation = split.holdout_split(rows, contract.identifier, fraction=0.2, seed=seed, bucket=bucket)
    small = seeded_sample(training, identifier=contract.identifier, label=contract.label, limit=train_rows, seed=seed)
    candidate = train.Candidate("sample_forest", "forest", features.sample_forest(label=contract.label))
    return compare_candidates([candidate], small, validation, contract)[0]


# --- named queries ---------------------------------------------------------------------------


def in_bounds(measures: DataFrame, *names: str, f1: float, areas: float = 0.0) -> DataFrame:
    """Of measured parts: the rows of each label, and whether threshold and measures lie where they must."""
    grid = [F.lit(threshold) for threshold in (*evaluate.THRESHOLDS, *evaluate.WINDOW_THRESHOLDS)]
    found = [F.col("f1").between(f1, 1).alias("f1_in_bounds")]
    for area in ("roc", "pr"):
        if f"{area}_auc" in measures.columns:
            found.append(F.col(f"{area}_auc").between(areas, 1).alias(f"{area}_in_bounds"))
    return measures.select(
        *names, (F.col("tp") + F.col("fn")).alias("positives"), (F.col("tn") + F.col("fp")).alias("negatives"),
        F.col("threshold").isin(grid).alias("threshold_of_grid"), *found,
    )


def compared_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.line_features(spark, folder)
    training, validation = split.holdout_split(rows, "id", fraction=0.2, seed=42, bucket=portable_bucket)
    return compare_candidates(default_candidates(), training, validation, tables.LINE_FEATURES)[1]


@query
def candidate_comparison(spark, folder):
    """The default candidates on the same split of all order lines."""
    return compared_lines(spark, folder).drop("fit_seconds", "predict_seconds")


@query
def candidate_comparison_check(spark, folder):
    """All four candidates are measured on every held-out line of each label, and tell dear lines from others."""
    return in_bounds(compared_lines(spark, folder), "name", "family", f1=0.9, areas=0.95)


def score_locked(spark: SparkSession, folder: str) -> DataFrame:
    """A logistic regression is fitted, locked, loaded again and scores all order lines."""
    rows = tables.line_features(spark, folder)
    training, _ = split.holdout_split(rows, "id", fraction=0.2, seed=42)
    path = scratch_path(spark, "locked-model")
    model = features.fit_on_vectors(written(training, "training"), tables.LINE_FEATURES, features.logistic())
    score.lock_model(spark, model, path, name="logistic", threshold=0.5)
    model, lock = score.load_locked(spark, path)
    named = dict(run_id="run", scored_at="", model_name=lock.model_name, model_sha256=lock.model_sha256)
    return score.scored_rows(model.transform(rows), threshold=lock.decision_threshold, **named)[1]


@query
def locked_scores(spark, folder):
    """All order lines with the scores of the locked model."""
    return score_locked(spark, folder).drop("run_id", "scored_at", "model_sha256")


@query
def locked_scores_check(spark, folder):
    """The scored lines by their class: all are there, decided at the locked threshold, with a chance in [0, 1]."""
    chance = F.col("attack_probability")
    decided = F.col("prediction") == (chance >= F.col("decision_threshold")).cast("int")
    right = F.col("is_correct") == (F.col("predicted_class") == F.col("actual_class"))
    return score_locked(spark, folder).groupBy("actual_class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(decided & right).alias("decided_rows"),
        F.count_if(chance.between(0, 1)).alias("rows_in_range"),
        F.count_distinct("model_sha256").alias("models"),
        (F.avg(F.col("is_correct").cast("double")) >= 0.9).alias("mostly_right"),
    )


@query
def sampled_forest(spark, folder):
    """The small forest on a balanced sample, its threshold and ranking measures."""
    fitted = sampled_job(tables.line_features(spark, folder), tables.LINE_FEATURES)
    return fitted.report.drop("fit_seconds", "predict_seconds")


@query
def sampled_forest_check(spark, folder):
    """The small forest, fitted on a bounded sample, is measured on every held-out line and tells dear lines from others."""
    rows = tables.line_features(spark, folder)
    fitted = sampled_job(rows, tables.LINE_FEATURES, bucket=portable_bucket)
    return in_bounds(fitted.report, "name", "family", f1=0.85, areas=0.9)


@query
def session_measures(spark, folder):
    """The session classifier on the runs of the events."""
    return session_job(tables.flow_events(spark, folder), tables.run_truth(spark, folder)).measures


@query
def session_measures_check(spark, folder):
    """The session classifier is measured on every complete run of each part; a session's label cannot be told well here."""
    measures = session_job(tables.flow_events(spark, folder), tables.run_truth(spark, folder)).measures
    return in_bounds(measures, "part", f1=0.0)


def measure_windows(spark: SparkSession, folder: str) -> DataFrame:
    truth = tables.event_truth(spark, folder).select("event_id", "label")
    labelled = written(windows.labelled_windows(tables.flow_events(spark, folder), truth, seconds=DAY), "labelled")
    day = F.dayofmonth("window_start")
    parts = {
        "train": labelled.where(day <= 18),
        "validation": labelled.where((day > 18) & (day <= 24)),
        "test": labelled.where(day > 24),
    }
    return window_job(parts, {"train": "first", "validation": "second", "test": "third"}).measures


@query
def window_measures(spark, folder):
    """The window classifier on three periods of the events, beside the rule."""
    return measure_windows(spark, folder)


@query
def window_measures_check(spark, folder):
    """Windows of each label that were measured: all of their period, the rule and the model alike."""
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    grid = [F.lit(threshold) for threshold in evaluate.WINDOW_THRESHOLDS]
    return measure_windows(spark, folder).select(
        "part", positives.alias("positives"), negatives.alias("negatives"),
        (F.col("threshold").isin(grid) | (F.col("part") == "baseline")).alias("threshold_of_grid"),
    )
