import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from flowsight.contract import EVENT_TRUTH_SCHEMA, FLOW, ddl
from flowsight.operators import evaluate, features, score, split, train
from flowsight.operators.windows import SESSION_FEATURES, WINDOW_FEATURES
from flowsight.plans import batch, learning
from flowsight.contract import Contract
from flowsight.session import spread, written

SMALL = Contract(
    schema=ddl("id bigint, proto string, dur double, sbytes bigint, attack_cat string, label int"),
    identifier="id", categorical=("proto",), category="attack_cat", label="label",
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1, 401).select(
        "id",
        F.concat(F.lit("p"), F.col("id") % 3).alias("proto"),
        (F.col("id") % 7 + 3 * (F.col("id") % 2)).cast("double").alias("dur"),
        (F.col("id") % 11).alias("sbytes"),
        F.when(F.col("id") % 2 == 1, "DoS").otherwise("Normal").alias("attack_cat"),
        (F.col("id") % 2).cast("int").alias("label"),
    )


def test_unseen_categories_do_not_fail(spark, flow_row):
    data = [flow_row(id=i, dur=float(i), label=i % 2, proto="tcp" if i % 3 else "udp") for i in range(1, 9)]
    model = features.contract_model().fit(spark.createDataFrame(data, FLOW.schema))
    strange = spark.createDataFrame([flow_row(id=99, proto="new", service="new", state="new")], FLOW.schema)
    row = model.transform(strange).select("features", "probability").first()
    assert 0.0 <= row.probability[1] <= 1.0
    assert len(row.features) == len(FLOW.numeric) + 4 + 3 + 3
    assert [type(s).__name__ for s in model.stages][-1] == "LogisticRegressionModel"


def test_identifier_and_targets_are_no_features():
    used = set(FLOW.numeric) | set(FLOW.categorical)
    assert not used & {"id", "attack_cat", "label"} and len(FLOW.numeric) == 39


def test_comparison_locks_the_winner(spark, rows, tmp_path):
    candidates = [
        train.Candidate("weighted", "logistic", features.logistic(max_iter=5, weight="class_weight"), weighted=True),
        train.Candidate("forest", "forest", features.forest(3, 3)),
    ]
    path = str(tmp_path / "final")
    lock, reports = learning.comparison_job(rows, path, SMALL, candidates=candidates)
    assert {r.name for r in reports.collect()} == {"weighted", "forest"}
    assert lock.model_name == train.best_candidate(reports).first().name
    model, loaded = score.load_locked(spark, path)
    assert loaded == lock and 0 < lock.decision_threshold < 1
    details = train.details_table(rows, lock.model_name, model.stages[-1])
    assert {r.detail for r in details.collect()} in ({"trees", "nodes", "used_features"}, {"coefficient_norm", "nonzero_coefficients", "intercept"})
    scored = score.score_batch(rows, model, lock, str(tmp_path / "scores"), run_id="r", scored_at="t", csv=True)
    assert scored.count() == 400 and spark.read.csv(str(tmp_path / "scores/csv"), header=True).count() == 400
    with pytest.raises(Exception, match="(?i)already exists"):
        score.score_batch(rows, model, lock, str(tmp_path / "scores"), run_id="r", scored_at="t")
    (tmp_path / "final/model/metadata/more").write_text("changed")
    with pytest.raises(ValueError, match="does not match"):
        score.load_locked(spark, path)


def test_only_the_selected_model_is_locked(spark, rows, tmp_path):
    candidate = train.Candidate("forest", "forest", features.forest(2, 2))
    training, validation = rows.where("id <= 300"), rows.where("id > 300")
    winner, reports = learning.compare_candidates([candidate], training, validation, SMALL)
    threshold = winner.report.first().threshold
    for stated in ({"name": "other"}, {"threshold": threshold + 0.01}, {"trees": 3}):
        with pytest.raises(ValueError, match="not the selected model"):
            learning.lock_winner(winner, reports, str(tmp_path / "no"), **{"name": "forest", "threshold": threshold, "trees": 2, **stated})
    lock = learning.lock_winner(winner, reports, str(tmp_path / "yes"), name="forest", threshold=threshold, trees=2)
    assert score.load_locked(spark, str(tmp_path / "yes"))[1] == lock


def test_scored_rows_decide_at_the_locked_threshold(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("probability", VectorUDT()), T.StructField("prediction", T.DoubleType())])
    df = spark.createDataFrame([(1, Vectors.dense(0.45, 0.55), 1.0), (2, Vectors.dense(0.35, 0.65), 1.0)], schema)
    particulars = dict(run_id="r", scored_at="t", model_name="m", model_sha256="d")
    rich, flat = score.scored_rows(df, threshold=0.6, **particulars)
    found = {r.id: r for r in flat.collect()}
    assert [(found[i].prediction, found[i].model_prediction_at_0_5, found[i].predicted_class) for i in (1, 2)] == [(0, 1, "Normal"), (1, 1, "Attack")]
    assert found[1].label is None and found[1].is_correct is None and found[1].actual_class is None
    assert "probability" in rich.columns and "probability" not in flat.columns
    full = df
    for name in ("proto", "service", "state", "attack_cat"):
        full = full.withColumn(name, F.lit("x"))
    _, flat = score.scored_rows(full.withColumn("label", F.lit(1)), threshold=0.6, **particulars)
    assert len(flat.columns) == 17
    assert [(r.is_correct, r.actual_class) for r in flat.orderBy("id").collect()] == [(False, "Attack"), (True, "Attack")]


def test_full_training_scores_the_test_part_once(spark, rows, tmp_path):
    part = F.when(F.col("id") <= 240, "train").when(F.col("id") <= 320, "validation").otherwise("test")
    lock, scored, measures = learning.full_training_job(rows.withColumn("split", part), str(tmp_path / "run"), SMALL, max_iter=5)
    assert scored.count() == measures.first().total == 80
    model, _ = score.load_locked(spark, str(tmp_path / "run/locked"))
    once = train.test_once(model, rows, lock.decision_threshold, str(tmp_path / "once"))
    assert once.first().total == 400
    with pytest.raises(Exception, match="(?i)already exists"):
        train.test_once(model, rows, lock.decision_threshold, str(tmp_path / "once"))


def test_full_training_writes_no_training_rows_again(rows, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(learning, "written", lambda df, name: names.append(name) or written(df, name))
    part = F.when(F.col("id") <= 240, "train").when(F.col("id") <= 320, "validation").otherwise("test")
    saved = split.save_split(rows.withColumn("split", part), str(tmp_path / "split"))
    learning.full_training_job(saved, str(tmp_path / "run"), SMALL, max_iter=5)
    assert names == ["candidates"]


def test_many_rows_of_a_fit_are_held_on_disk_only(rows):
    for many, memory in ((1_000, True), (100, False)):
        with features.dealt(rows, many) as held:
            assert (held.storageLevel.useMemory, held.storageLevel.useDisk) == (memory, True)
            assert held.collect() == spread(rows).collect()
        assert not held.storageLevel.useDisk


def test_sampled_and_baseline_jobs(rows):
    fitted = learning.sampled_job(rows, SMALL, train_rows=100)
    report = fitted.report.first()
    held = split.holdout_split(rows, "id", fraction=0.2, seed=42)[1].count()
    assert report.total == held and 0 <= report.roc_auc <= 1
    assert train.model_details(fitted.model.stages[-1])["trees"] == 12


def test_session_job_uses_calibration_runs_and_measures_the_challenge(spark, tmp_path):
    rng = random.Random(4)
    flows, truth = [], []
    for mode, runs in (("calibration", 10), ("training", 4)):
        for i in range(runs):
            for label in (0, 1):
                run, n = f"{mode}-{i}-{label}", 3 + i % 3
                truth.append((run, "s", label, mode, n))
                for k in range(n):
                    port = rng.randint(20, 500) if label else 8080
                    flows.append((f"{run}-{k}", run, "a", "e", mode, "flow", f"2026-01-01T00:00:{k:02d}Z", "ip", 1, port, "tcp", "ssh" if label else "http", 0.5, 10, 20))
    from flowsight.contract import FLOW_EVENT_SCHEMA, RUN_TRUTH_SCHEMA

    flows, truth = spark.createDataFrame(flows, FLOW_EVENT_SCHEMA), spark.createDataFrame(truth, RUN_TRUTH_SCHEMA)
    trained = learning.session_job(flows, truth, trees=3)
    measures = {r.part: r for r in trained.measures.collect()}
    assert set(measures) == {"validation", "test", "challenge"}
    assert measures["challenge"].total == 8 and measures["challenge"].f1 == 1.0
    from flowsight.operators.windows import complete_sessions

    audit = learning.challenge_audit(trained.model, complete_sessions(flows, truth), trained.threshold)
    assert audit.first().total == 8
    with pytest.raises(ValueError, match="no complete"):
        learning.challenge_audit(trained.model, complete_sessions(flows.where("lab_mode <> 'training'"), truth), trained.threshold)
    flow_rows = flows.select(F.xxhash64("event_id").alias("id"), "dur", "sbytes", "dbytes", "proto", "service", (F.col("service") == "ssh").cast("int").alias("label"))
    assert learning.flow_job(flow_rows, flow_rows.where("id % 3 = 0"), trees=2).measures.where("part = 'test'").first().f1 == 1.0
    saved = learning.lab_job(flow_rows, flow_rows.where("id % 3 = 0"), flows, truth, str(tmp_path / "lab"))
    assert set(saved) == {"flow", "session"}
    for name, found in saved.items():
        model, lock = score.load_locked(spark, str(tmp_path / "lab" / name))
        assert lock == found.lock and lock.decision_threshold == found.trained.threshold and lock.model_name == f"{name}_forest"
        assert spark.read.parquet(str(tmp_path / "lab" / name / "measures")).where("part = 'test'").first().f1 == 1.0
    model, lock = score.load_locked(spark, str(tmp_path / "lab" / "flow"))
    scored = model.transform(flow_rows)
    assert evaluate.measure_at(scored, lock.decision_threshold).first().f1 == 1.0
    with pytest.raises(Exception, match="(?i)already exists"):
        learning.lab_job(flow_rows, flow_rows, flows, truth, str(tmp_path / "lab"))


def test_window_job_refuses_few_windows_and_beats_no_rule(spark):
    def part(n):
        cells = [F.lit(10.0).alias(c) for c in WINDOW_FEATURES if c not in ("port_scan_ratio", "flow_rate")]
        label = (F.col("id") % 2).cast("int")
        return spark.range(n).select(*cells, label.alias("label"), label.cast("double").alias("port_scan_ratio"), F.lit(1.0).alias("flow_rate"))

    names = {"train": "e1", "validation": "e2", "test": "e3"}
    trained = learning.window_job({name: part(40) for name in names}, names, trees=2)
    measures = {r.part: r.f1 for r in trained.measures.collect()}
    assert measures["baseline"] == 1.0 and measures["test"] == 1.0
    with pytest.raises(ValueError, match="too few"):
        learning.window_job({name: part(4) for name in names}, names)
    labelled = part(40).withColumn("experiment_id", F.explode(F.array(*[F.lit(name) for name in (*names.values(), "e9")])))
    again = learning.experiments_job(labelled, names, trees=2)
    counts = {r.part: r.tp + r.fn + r.tn + r.fp for r in again.measures.collect()}
    assert counts == {"validation": 40, "test": 40, "baseline": 40}
    assert len(SESSION_FEATURES) == len(WINDOW_FEATURES) == 8


def test_defaults_of_the_candidates():
    classifiers = {c.name: c.classifier for c in learning.default_candidates()}
    assert isinstance(classifiers["logistic_balanced"], LogisticRegression)
    assert classifiers["logistic_balanced"].getWeightCol() == "class_weight"
    assert (classifiers["forest_depth12"].getNumTrees(), classifiers["forest_depth12"].getMaxDepth()) == (50, 12)
    assert len(evaluate.THRESHOLDS) == 17 and EVENT_TRUTH_SCHEMA.fieldNames() == ["event_id", "label"]


def test_batch_jobs_from_csv_to_split(spark, flow_row, tmp_path):
    data = [flow_row(id=i, dur=float(i), sbytes=i, label=i % 2, attack_cat=" dos " if i % 2 else "normal", service="-" if i % 4 else "http") for i in range(1, 121)]
    spark.createDataFrame(data, FLOW.schema).coalesce(1).write.option("header", True).csv(str(tmp_path / "raw"))
    bronze = batch.bronze_job(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), expected_rows=120, sample_path=str(tmp_path / "sample"), sample_rows=5)
    assert bronze.rows.count() == 120
    assert spark.read.csv(str(tmp_path / "sample"), header=True).count() == 10
    silver = batch.silver_job(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    from flowsight.sources import manifest

    listed = manifest.file_manifest(spark, str(tmp_path / "raw")).where("name LIKE '%.csv'").select("name", "bytes", "md5")
    again = batch.bronze_job(spark, str(tmp_path / "raw"), str(tmp_path / "bronze2"), expected_rows=120, expected_files=listed)
    assert {r.status for r in again.reports["files"].collect()} <= {"verified", "unexpected"} and again.rows.count() == 120
    with pytest.raises(ValueError, match="digest_differs"):
        batch.bronze_job(
            spark, str(tmp_path / "raw"), str(tmp_path / "bronze2"), expected_rows=120, expected_files=listed.withColumn("md5", F.lit("0"))
        )
    # the last good table is still there
    assert spark.read.parquet(str(tmp_path / "bronze2")).count() == 120
    assert {r.service for r in silver.rows.select("service").distinct().collect()} == {"__unknown__", "http"}
    reports = batch.profile_job(silver.rows)
    assert {r.attack_cat for r in reports["category_share"].collect()} == {"Normal", "DoS"}
    assert reports["numeric_profile"].count() == 2 and reports["correlations"].count() >= 1
    parted = batch.split_job(silver.rows, str(tmp_path / "parts"))
    assert parted.reports["features"].first().features == 39 + 3 + 4 + 3
    assert sum(r["rows"] for r in parted.reports["counts"].collect()) == 120


def test_prepare_job_drops_conflicts_and_keeps_copies(spark, tmp_path):
    from flowsight.contract import RAW_FLOW

    base = {c: "1" for c in RAW_FLOW.columns} | {"proto": "tcp", "state": "FIN", "service": "http"}
    files = {"one.csv": [], "two.csv": []}
    for i in range(200):
        label = i % 2
        row = {**base, "sport": hex(i), "attack_cat": "Worms" if label else "", "label": str(label)}
        line = ",".join(row[c] for c in RAW_FLOW.columns)
        files["one.csv"].append(line)
        if i < 20:
            files["two.csv"].append(line)
    clash = {**base, "sport": "0x3", "attack_cat": "", "label": "0"}
    files["two.csv"].append(",".join(clash[c] for c in RAW_FLOW.columns))
    (tmp_path / "in").mkdir()
    for name, lines in files.items():
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    stored = batch.prepare_job(spark, str(tmp_path / "in"), list(files), str(tmp_path / "out"), verified_rows=221, published_rows=220)
    keys = stored.reports["keys"].first()
    assert (keys.rows, keys.unique_keys, keys.conflicting_keys, keys.conflicting_rows) == (221, 200, 1, 3)
    assert stored.rows.count() == 218
    spread = stored.rows.groupBy("flow_fingerprint").agg(F.count_distinct("split").alias("parts"), F.count(F.lit(1)).alias("n"))
    assert spread.agg(F.max("parts"), F.max("n")).first() == (1, 2)
    assert {r.attack_cat for r in stored.rows.select("attack_cat").distinct().collect()} == {"Worms", "Normal"}
    assert stored.reports["counts"].first().difference_from_published == 1


def test_alert_job(spark, tmp_path):
    df = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 40).alias("attack_probability"), (F.col("id") >= 20).cast("int").alias("prediction"), F.lit("tcp").alias("proto"))
    tables = batch.alert_job(df, str(tmp_path / "alerts"), df.columns, groups=["proto"], limit=4, errors=2)
    assert {name: t.count() for name, t in tables.items()} == {"alerts": 4, "false_positives": 2, "false_negatives": 2, "alert_distribution": 1, "measures": 1}
