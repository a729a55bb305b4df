from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowsight.contract import EVENT_TRUTH_SCHEMA, FLOW_EVENT_SCHEMA, RUN_TRUTH_SCHEMA, WINDOW_TRUTH_SCHEMA
from flowsight.operators import reconcile, windows

BASE = {
    "run_id": "r1", "actor_id": "a1", "experiment_id": "e1", "lab_mode": "live", "record_type": "flow", "source_ip": "10.0.0.1",
    "source_port": 5000, "destination_port": 8080, "proto": "tcp", "service": "http", "dur": 1.0, "sbytes": 10, "dbytes": 20,
}


def flow(event_id, timestamp, **changes):
    row = {**BASE, "event_id": event_id, "timestamp": timestamp, **changes}
    return tuple(row[c] for c in FLOW_EVENT_SCHEMA.fieldNames())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), FLOW_EVENT_SCHEMA)


def test_windows_per_source_and_time(spark):
    flows = frame(
        spark,
        flow("1", "2026-01-01T00:00:01Z"),
        flow("2", "2026-01-01T00:00:09Z", destination_port=22, service="ssh", sbytes=30),
        flow("3", "2026-01-01T00:00:10Z"),
        flow("4", "2026-01-01T00:00:05Z", source_ip="10.0.0.2", actor_id="a2", destination_port=None),
        flow("5", "2026-01-01T00:00:05Z", experiment_id="e2"),
        flow("6", "no time"),
        flow("7", "2026-01-01T00:00:05Z", source_ip=None),
        flow("8", "2026-01-01T00:00:05Z", experiment_id=None),
    )
    found = windows.window_features(flows)
    assert found.count() == 4
    double = found.where("flow_count = 2").first()
    assert (double.port_scan_ratio, double.flow_rate, double.http_ratio, double.mean_sbytes) == (0.5, 0.2, 0.5, 20.0)
    assert (double.window_end - double.window_start).total_seconds() == double.elapsed_seconds == 10.0
    assert found.where("source_ip = '10.0.0.2'").first().port_scan_ratio == 0.0
    assert "label" not in found.columns


def test_session_features(spark):
    flows = frame(
        spark,
        flow("1", "2026-01-01T00:00:00Z"),
        flow("2", "2026-01-01T00:00:00.5Z", destination_port=22),
        flow("3", "2026-01-01T00:00:01Z"),
        flow("4", "2026-01-01T00:00:01Z", run_id="r2"),
        flow("5", "2026-01-01T00:00:01Z", record_type="control"),
        flow("6", "2026-01-01T00:00:01Z", run_id=None),
    )
    rows = {r.run_id: r for r in windows.session_features(flows).collect()}
    assert set(rows) == {"r1", "r2"}
    first = rows["r1"]
    assert (first.flow_count, first.destination_port_count, first.elapsed_seconds, first.flow_rate) == (3.0, 2.0, 1.0, 3.0)
    assert (rows["r2"].elapsed_seconds, rows["r2"].flow_rate) == (0.001, 1.0)


def test_incomplete_runs_are_left_out(spark):
    flows = frame(
        spark,
        flow("1", "2026-01-01T00:00:00Z", run_id="whole", lab_mode="training"),
        flow("2", "2026-01-01T00:00:01Z", run_id="whole", lab_mode="training"),
        flow("3", "2026-01-01T00:00:01Z", run_id="short", lab_mode="training"),
        flow("4", "2026-01-01T00:00:01Z", run_id="live", lab_mode="live"),
    )
    truth = [("whole", "s", 1, "training", 2), ("short", "s", 0, "training", 2), ("live", "s", 0, "live", 1)]
    sessions = windows.complete_sessions(flows, spark.createDataFrame(truth, RUN_TRUTH_SCHEMA))
    assert [(r.run_id, r.label, r.lab_mode) for r in sessions.collect()] == [("whole", 1, "training")]


def test_labelled_windows_are_ended_whole_and_pure(spark):
    def at(second, event_id, **changes):
        return flow(event_id, f"2026-01-01T00:00:{second:02d}Z", **changes)

    flows = frame(
        spark,
        at(1, "a"), at(2, "b"), at(2, "b"),            # whole, repeated event counted once
        at(11, "c"), at(12, "d"),                        # mixed labels
        at(21, "e"), at(22, "f"),                        # f is unlabelled
        at(31, "g"),                                     # whole
        at(41, "h"),                                     # not ended
    )
    truth = [("a", 1), ("b", 1), ("c", 0), ("d", 1), ("e", 0), ("g", 0), ("h", 1)]
    found = windows.labelled_windows(flows, spark.createDataFrame(truth, EVENT_TRUTH_SCHEMA))
    rows = [(r.window_start.second, r.flow_count, r.label) for r in found.orderBy("window_start").collect()]
    assert rows == [(0, 2.0, 1), (30, 1.0, 0)]
    assert "labelled_count" not in found.columns


def test_repeated_truth_makes_a_window_incomplete(spark):
    flows = frame(spark, flow("a", "2026-01-01T00:00:01Z"), flow("z", "2026-01-01T00:01:00Z"))
    truth = spark.createDataFrame([("a", 1), ("a", 1), ("z", 1)], EVENT_TRUTH_SCHEMA)
    assert windows.labelled_windows(flows, truth).isEmpty()


def test_rule_score(spark):
    df = spark.createDataFrame([(0.5, 0.1), (0.4, 10.0), (0.4, 9.9)], "port_scan_ratio double, flow_rate double")
    assert [r.rule_score for r in windows.rule_score(df).collect()] == [1.0, 1.0, 0.0]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("s1", 0, 1, 0), ("s1", 10, 2, 1), ("s2", 0, 1, 1), ("s3", 0, 1, 0)]
    start = (F.timestamp_seconds(F.lit(1_767_225_600) + F.col("offset"))).alias("window_start")
    df = spark.createDataFrame(rows, "source_ip string, offset int, flow_count double, prediction int".replace("double", "int"))
    return df.select(
        "source_ip", start, F.timestamp_seconds(F.lit(1_767_225_610) + F.col("offset")).alias("window_end"),
        F.col("flow_count").cast("double").alias("flow_count"), "prediction",
    )


@pytest.fixture(scope="module")
def truth(spark):
    rows = [
        ("2026-01-01T00:00:03Z", "s1", 0, "web"), ("2026-01-01T00:00:12Z", "s1", 0, "web"), ("2026-01-01T00:00:13Z", "s1", 1, "scan"),
        ("2026-01-01T00:00:01Z", "s2", 0, "web"), ("bad", "s3", 1, "scan"), (None, "s3", 1, "scan"),
    ]
    return spark.createDataFrame(rows, WINDOW_TRUTH_SCHEMA)


def verdicts(df):
    return {(r.source_ip, r.window_start.second): (r.checked, r.outcome, r.actual) for r in df.collect()}


def test_reconcile_after_the_run(scored, truth):
    found = verdicts(reconcile.reconcile(scored, truth, run_complete=True))
    assert found == {
        ("s1", 0): (True, "true_negative", 0),
        ("s1", 10): (True, "true_positive", 1),
        ("s2", 0): (True, "false_positive", 0),
        ("s3", 0): (False, "awaiting_truth", None),
    }


def test_reconcile_by_watermark(scored, truth):
    watermark = F.timestamp_seconds(F.lit(1_767_225_610))
    found = verdicts(reconcile.reconcile(scored, truth, watermark=watermark))
    assert found["s1", 0] == (True, "true_negative", 0) and found["s1", 10] == (False, "provisional", None)
    none = reconcile.outcome_counts(reconcile.reconcile(scored, truth)).collect()
    assert [(r.outcome, r.windows) for r in none] == [("provisional", 4)]


def test_latest_and_numbered_windows(spark):
    rows = [("a", datetime(2026, 1, d, h), 1.0 * d) for d in (1, 2) for h in (0, 5)] + [("b", datetime(2026, 1, 1, 7), 9.0), (None, datetime(2026, 1, 1), 0.0)]
    df = spark.createDataFrame(rows, "actor_id string, window_start timestamp, flow_rate double")
    latest = {r.actor_id: r.flow_rate for r in reconcile.latest_windows(df).collect()}
    assert latest == {"a": 2.0, "b": 9.0}
    numbers = sorted((r.window_start, r.window_number) for r in reconcile.numbered_windows(df).where("actor_id = 'a'").collect())
    assert [n for _, n in numbers] == [1, 2, 3, 4]
    assert {r.actor_id: r.windows for r in reconcile.windows_per_source(df).collect()} == {"a": 4, "b": 1, None: 1}
