import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowsight.operators import alerts, evaluate, train

SCORES = [(1, 0.9), (1, 0.6), (1, 0.4), (0, 0.8), (0, 0.3), (0, 0.1)]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "label int, attack_score double")


def cells(row):
    return row.tp, row.fp, row.tn, row.fn


def test_threshold_counts(scores):
    curve = {r.threshold: r for r in evaluate.threshold_curve(scores, [0.7, 0.5], score="attack_score").collect()}
    assert cells(curve[0.5]) == (2, 1, 2, 1) and cells(curve[0.7]) == (1, 1, 2, 2)
    assert curve[0.5].precision == curve[0.5].recall == pytest.approx(2 / 3)
    assert curve[0.7].false_negative_rate == pytest.approx(2 / 3)
    assert curve[0.7].predicted_positive_rate == pytest.approx(1 / 3)


def test_curve_equals_direct_counts_at_every_threshold(spark):
    rows = [(i % 2, (i * 37 % 101) / 100) for i in range(500)] + [(1, None), (None, 0.5), (2, 0.5), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    grid = [i / 20 for i in range(1, 20)]
    for row in evaluate.threshold_curve(df, grid, score="score").collect():
        t = row.threshold
        direct = df.withColumn("prediction", (F.col("score") >= t).cast("int"))
        assert cells(row) == tuple(evaluate.confusion(direct).first())


def test_curve_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "label int, score double")
    rows = evaluate.threshold_curve(empty, [0.2, 0.8], score="score").collect()
    assert [(r.threshold, cells(r), r.f1, r.accuracy) for r in rows] == [(0.2, (0, 0, 0, 0), 0.0, 0.0), (0.8, (0, 0, 0, 0), 0.0, 0.0)]


def test_probability_vectors(spark, scores):
    vector = array_to_vector(F.array(1 - F.col("attack_score"), F.col("attack_score")))
    row = evaluate.threshold_curve(scores.withColumn("probability", vector), [0.5]).first()
    assert cells(row) == (2, 1, 2, 1)


@pytest.mark.parametrize("grid", [[], [0.0], [1.0], [float("nan")]])
def test_bad_grids(scores, grid):
    with pytest.raises(ValueError):
        evaluate.threshold_curve(scores, grid, score="attack_score")


def test_threshold_choice(spark):
    rows = [(0.3, 0.8, 0.7, 0.1), (0.4, 0.8, 0.9, 0.2), (0.6, 0.8, 0.9, 0.2), (0.7, 0.8, 0.9, 0.2), (0.5, 0.7, 1.0, 0.0)]
    curve = spark.createDataFrame(rows, "threshold double, f1 double, recall double, false_positive_rate double")
    assert evaluate.best_threshold(curve).first().threshold == 0.4
    assert evaluate.best_threshold(curve.where("threshold <> 0.4")).first().threshold == 0.6
    assert evaluate.best_threshold(curve, "recall").first().threshold == 0.5
    assert evaluate.most_sensitive_threshold(curve.where("threshold <> 0.4")).first().threshold == 0.6
    lower = curve.union(spark.createDataFrame([(0.1, 0.8, 0.9, 0.2)], curve.schema))
    assert evaluate.most_sensitive_threshold(lower).first().threshold == 0.1
    assert evaluate.best_threshold(lower).first().threshold == 0.4
    with pytest.raises(ValueError, match="missing"):
        evaluate.best_threshold(curve, "profit")


def test_confusion_needs_its_columns(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0), (None, 1)], "label int, prediction int")
    assert tuple(evaluate.confusion(df).first()) == (1, 1, 1, 1)
    with pytest.raises(ValueError, match="prediction"):
        evaluate.confusion(df.drop("prediction"))


def test_ranking_measures(scores):
    row = evaluate.ranking_measures(scores, raw="attack_score").first()
    pairs = [(a, b) for la, a in SCORES if la for lb, b in SCORES if not lb]
    assert row.roc_auc == pytest.approx(sum(a > b for a, b in pairs) / len(pairs))
    assert 0 < row.pr_auc <= 1


def test_ranking_measures_are_exact_for_any_scores(spark):
    rng = random.Random(7)
    data = [(rng.randint(0, 1), rng.choice([rng.random(), 0.25, -3.0])) for _ in range(300)] + [(None, 0.5), (1, None)]
    row = evaluate.ranking_measures(spark.createDataFrame(data, "label int, s double"), raw="s", slots=8).first()
    known = [(label, s) for label, s in data if label is not None and s is not None]
    ones, zeros = [s for label, s in known if label], [s for label, s in known if not label]
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    assert row.roc_auc == pytest.approx(wins / len(ones) / len(zeros))
    area, recall, precision = 0.0, 0.0, None
    for cut in sorted({s for _, s in known}, reverse=True):
        tp, fp = sum(s >= cut for s in ones), sum(s >= cut for s in zeros)
        now = tp / (tp + fp)
        area += (tp / len(ones) - recall) * (now + (now if precision is None else precision)) / 2
        recall, precision = tp / len(ones), now
    assert row.pr_auc == pytest.approx(area)


@pytest.mark.parametrize("data", [[], [(1, 0.5), (1, 0.7)], [(0, 0.5)]])
def test_ranking_measures_need_both_labels(spark, data):
    row = evaluate.ranking_measures(spark.createDataFrame(data, "label int, s double"), raw="s").first()
    assert row.roc_auc is None and row.pr_auc is None


def test_challenge_is_empty_without_runs(spark):
    df = spark.createDataFrame([(1, 0.9, "training"), (0, 0.2, "calibration")], "label int, score double, lab_mode string")
    assert evaluate.challenge_measures(df, 0.5, score="score").first().tp == 1
    assert evaluate.challenge_measures(df.where("lab_mode = 'calibration'"), 0.5, score="score").isEmpty()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    weights = {r.label: r.weight for r in train.class_weights(df).collect()}
    assert weights == {0: 1.5, 1: 0.75}
    assert [r.class_weight for r in train.with_class_weights(df, weights).orderBy("label").collect()] == [1.5, 0.75, 0.75]
    with pytest.raises(Exception, match="both needed"):
        train.class_weights(df.where("label = 1")).collect()
    with pytest.raises(ValueError):
        train.with_class_weights(df, {0: 1.0})


def test_best_candidate_ties(spark):
    columns = "name string, f1 double, recall double, false_positive_rate double, predict_seconds double, fit_seconds double"
    rows = [("b", 0.9, 0.8, 0.1, 1.0, 2.0), ("a", 0.9, 0.8, 0.1, 1.0, 2.0), ("c", 0.9, 0.8, 0.2, 0.1, 0.1), ("d", 0.8, 1.0, 0.0, 0.1, 0.1)]
    assert train.best_candidate(spark.createDataFrame(rows, columns)).first().name == "a"


@pytest.fixture(scope="module")
def decided(spark):
    rows = [(i, "tcp" if i % 3 else "udp", i % 2, i / 40, int(i >= 20)) for i in range(40)]
    return spark.createDataFrame(rows, "id int, proto string, label int, attack_probability double, prediction int")


def test_alert_tables(decided, plan_of):
    tables = alerts.alert_export(decided, decided.columns, alerts=5, errors=3, groups=["proto"])
    assert [r.id for r in tables["alerts"].collect()] == [39, 38, 37, 36, 35]
    assert [r.id for r in tables["false_positives"].collect()] == [38, 36, 34]
    assert [r.id for r in tables["false_negatives"].collect()] == [1, 3, 5]
    assert [(r.value, r.alert_count) for r in tables["alert_distribution"].collect()] == [("tcp", 13), ("udp", 7)]
    assert "TakeOrderedAndProject" in plan_of(tables["alerts"])
    with pytest.raises(ValueError):
        alerts.alert_export(decided, decided.columns, alerts=0)


def test_outcome_examples(decided):
    found = {}
    for row in alerts.outcome_examples(decided, 2).collect():
        found.setdefault(row.outcome, []).append(row.id)
    assert {k: sorted(v) for k, v in found.items()} == {
        "true_positive": [21, 23], "false_positive": [20, 22], "false_negative": [1, 3], "true_negative": [0, 2],
    }
