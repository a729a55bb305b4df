import json

import pytest
from pyspark.sql import functions as F

from flowsight.contract import FLOW
from flowsight.operators import features, score
from flowsight.operators.windows import window_features
from flowsight.plans import live
from flowsight.streaming import progress, queries, sinks, sources

LABELLED = "id int, label int, source_file string"


@pytest.fixture(scope="module")
def flows(spark, flow_row):
    rows = [flow_row(id=i, dur=float(i), sbytes=i % 5, label=i % 2) for i in range(1, 31)]
    return spark.createDataFrame(rows, FLOW.schema)


def test_landing_takes_the_next_slice_once(spark, flows, tmp_path):
    path = str(tmp_path / "in")
    assert sources.land_batch(flows, path, 1, 7) == 7
    assert sorted(r.id for r in spark.read.parquet(f"{path}/batch-00001").collect()) == list(range(8, 15))
    with pytest.raises(Exception, match="(?i)already exists"):
        sources.land_batch(flows, path, 1, 7)
    with pytest.raises(ValueError, match="2 of 7"):
        sources.land_batch(flows, path, 4, 7)


def test_landing_many_batches_of_a_skewed_order(spark, tmp_path):
    rows = spark.range(400).selectExpr("cast(if(id < 300, 7, id % 3) as int) AS id", "cast(id % 2 as int) AS label", "id AS row")
    rows.repartition(5).write.parquet(str(tmp_path / "rows"))
    rows, path = spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "in")
    for index in range(8):
        sources.land_batch(rows, path, index, 50, task_rows=20)
    landed = sinks.read_batches(spark, path)
    assert sorted(row["row"] for row in landed.select("row").collect()) == list(range(400))
    first = spark.read.parquet(f"{path}/batch-00000").agg(F.max("id")).first()[0]
    last = spark.read.parquet(f"{path}/batch-00007").agg(F.min("id")).first()[0]
    assert (first, last) == (1, 7)


def test_paths_must_not_overlap():
    sources.check_paths(input="/a/in", output="/a/out", checkpoint="/a/in2")
    for bad in ("/a/in", "/a/in/deep", "/a"):
        with pytest.raises(ValueError, match="input and output overlap"):
            sources.check_paths(input="/a/in", output=bad, checkpoint="/b")


def test_names_and_triggers(spark, tmp_path):
    with pytest.raises(ValueError, match="not usable"):
        queries.require_name("bad name")
    with pytest.raises(ValueError, match="max_files"):
        sources.parquet_stream(spark, str(tmp_path), max_files=0)
    with pytest.raises(ValueError, match="at least 1 second"):
        queries.with_trigger(None, 0)


def test_batch_summary(spark):
    rows = [(1, "a", 0.2, 0), (2, "a", 0.8, 1), (3, "b", 0.9, 1)]
    df = spark.createDataFrame(rows, "id int, source_file string, attack_probability double, prediction int")
    row = sinks.batch_summary(df, batch_id=4, run_id="r", processed_at="t").first()
    assert (row.stream_batch_id, row.input_rows, row.alert_rows, row.normal_rows, row.source_file_count) == (4, 3, 2, 1, 2)
    assert (row.alert_rate, row.max_attack_probability) == (pytest.approx(2 / 3), 0.9)
    empty = sinks.batch_summary(df.where("id < 0"), batch_id=5, run_id="r", processed_at="t").first()
    assert (empty.input_rows, empty.alert_rate, empty.mean_attack_probability) == (0, 0.0, 0.0)
    assert len(empty) == 10 and None not in tuple(empty)


def test_restart_goes_on_with_new_files_only(spark, flows, tmp_path):
    model = features.contract_model().fit(flows)
    score.lock_model(spark, model, str(tmp_path / "lock"), name="lr", threshold=0.5)
    paths = dict(input_path=str(tmp_path / "in"), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), lock_path=str(tmp_path / "lock"))
    for index in (0, 1):
        sources.land_batch(flows, paths["input_path"], index, 2)
    first = live.scoring_job(spark, name="first", **paths)
    assert first.where("input_rows > 0").count() == 2
    sources.land_batch(flows, paths["input_path"], 2, 2)
    again = live.scoring_job(spark, name="again", **paths)
    assert again.agg(F.sum("input_rows")).first()[0] == 2
    stored = sinks.read_batches(spark, f"{paths['output']}/predictions")
    check = progress.restart_check(stored).first()
    assert (check.rows, check.distinct_ids, check.duplicate_ids, check.batches, check.consecutive) == (6, 6, 0, 3, True)
    assert {r.run_id for r in stored.select("run_id").distinct().collect()} == {"first", "again"}
    assert stored.where(F.col("prediction") != (F.col("attack_probability") >= 0.5).cast("int")).isEmpty()
    summaries = sinks.read_batches(spark, f"{paths['output']}/summaries")
    assert summaries.agg(F.sum("input_rows"), F.count(F.lit(1))).first() == (6, 3)


def test_every_report_is_kept_over_a_restart(spark, tmp_path):
    for part in range(2):
        for place in range(75):
            number = part * 75 + place
            (tmp_path / "in").mkdir(exist_ok=True)
            spark.range(number, number + 1).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{number:03d}"))
        source = sources.parquet_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
        name = f"reports-{tmp_path.name[-20:]}"
        with progress.ProgressRecorder(spark, str(tmp_path / "reports"), name) as recorder:
            writer = source.writeStream.queryName(name).format("noop").option("checkpointLocation", str(tmp_path / "cp"))
            run = queries.with_trigger(writer, None).start()
            run.awaitTermination()
            recorder.wait_for(run)
    kept = progress.recorded_progress(spark, str(tmp_path / "reports")).where("input_rows > 0")
    assert kept.count() == 150 and kept.select("batch_id").distinct().count() == 150
    assert kept.select("query_id").distinct().count() == 1 and kept.select("run_id").distinct().count() == 2
    assert kept.agg(F.sum("input_rows")).first()[0] == 150
    assert progress.progress_rows(spark, run.recentProgress).count() < 150
    progress.require_none_late(kept)
    with pytest.raises(ValueError, match="3 rows came behind"):
        progress.require_none_late(kept.limit(3).withColumn("late_rows", F.lit(1)))


def test_a_report_that_cannot_be_written_is_not_lost(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in" / "a"))
    (tmp_path / "file").write_text("no folder")
    name = f"broken-{tmp_path.name[-20:]}"
    source = sources.parquet_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
    with progress.ProgressRecorder(spark, str(tmp_path / "file"), name) as recorder:
        writer = source.writeStream.queryName(name).format("noop").option("checkpointLocation", str(tmp_path / "cp"))
        run = queries.with_trigger(writer, None).start()
        run.awaitTermination()
        with pytest.raises(Exception, match="(?i)file"):
            recorder.wait_for(run)


def test_the_restart_job_lands_runs_and_goes_on(spark, flows, tmp_path):
    score.lock_model(spark, features.contract_model().fit(flows), str(tmp_path / "lock"), name="lr", threshold=0.5)
    done = live.restart_job(spark, flows, str(tmp_path / "job"), lock_path=str(tmp_path / "lock"), name="job", size=4)
    assert sorted(r.id for r in done["scores"].collect()) == list(range(1, 13))
    assert done["check"].first().asDict() == {"rows": 12, "distinct_ids": 12, "duplicate_ids": 0, "batches": 3, "consecutive": True}
    assert done["summaries"].count() == 3 and done["progress"].agg(F.sum("input_rows")).first()[0] == 12
    with pytest.raises(ValueError, match="2 of 4"):
        live.restart_job(spark, flows, str(tmp_path / "far"), lock_path=str(tmp_path / "lock"), name="far", size=4, first=8)


STATE = "experiment_id string, source_ip string, window_start int, value int"


def folded_batches(batches):
    newest = {}
    for number, rows in enumerate(batches):
        newest |= {row[:3]: (row[3], number) for row in rows}
    return sorted((*key, *value) for key, value in newest.items())


def state_rows(spark, table):
    return sorted(tuple(row) for row in table.read(spark).select("experiment_id", "source_ip", "window_start", "value", "stream_batch_id").collect())


def test_state_is_merged_into_a_fixed_number_of_folders(spark, tmp_path):
    import random

    rng = random.Random(4)
    table = sinks.StateTable(str(tmp_path / "state"), every=3)
    batches, files = [], []
    for number in range(20):
        keys = rng.sample(range(12), 4)
        rows = [("e", f"s{key % 4}", key, rng.randrange(1_000)) for key in keys] if number != 5 else []
        batches.append(rows)
        table.write(spark.createDataFrame(rows, STATE), number)
        if number % 4 == 1:
            table.write(spark.createDataFrame(rows, STATE), number)  # a batch that comes again
        assert state_rows(spark, table) == folded_batches(batches), number
        files.append(sum(1 for path in (tmp_path / "state").rglob("part-*")))
    assert len(list((tmp_path / "state" / "deltas").iterdir())) == 9
    assert {path.name for path in (tmp_path / "state").iterdir()} == {"deltas", "base-0", "base-1", "commit-0", "commit-1"}
    assert table.commits(spark)[-1] == (5, 17)


def test_a_merge_cut_short_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table = sinks.StateTable(str(tmp_path / "state"), every=2)
    batches = [[("e", "s", number, number), ("e", "s", 100, number)] for number in range(6)]
    for number in range(5):
        table.write(spark.createDataFrame(batches[number], STATE), number)
    # the base is written and the commit is not
    monkeypatch.setattr(spark, "range", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.write(spark.createDataFrame(batches[5], STATE), 5)
    monkeypatch.undo()
    assert (tmp_path / "state" / "base-0").exists() and table.commits(spark)[-1] == (1, 3)
    assert state_rows(spark, table) == folded_batches(batches)
    # a commit folder without its file is as good as none
    for part in (tmp_path / "state" / "commit-0").glob("part-*"):
        part.unlink()
    assert table.commits(spark) == [(1, 3)] and state_rows(spark, table) == folded_batches(batches)
    table.write(spark.createDataFrame(batches[5], STATE), 5)
    assert table.commits(spark)[-1] == (2, 5) and state_rows(spark, table) == folded_batches(batches)


def test_state_of_null_keys(spark, tmp_path):
    table = sinks.StateTable(str(tmp_path / "state"), every=1)
    for number in range(3):
        table.write(spark.createDataFrame([("e", None, 1, number), (None, "s", None, number)], STATE), number)
    assert sorted((row[3], row[4]) for row in table.read(spark).select("*").collect()) == [(2, 2), (2, 2)]


def event(event_id, second, source="s1", **more):
    row = {
        "event_id": event_id, "experiment_id": "e", "source_ip": source, "actor_id": source, "record_type": "flow", "lab_mode": "live",
        "timestamp": f"2026-01-01T00:{second // 60:02d}:{second % 60:02d}Z", "destination_port": 8080, "service": "http",
        "dur": 0.5, "sbytes": 10, "dbytes": 20, **more,
    }
    return json.dumps(row)


def passed_through(windows):
    return windows.withColumn("attack_probability", F.lit(0.1)).withColumn("prediction", F.lit(0))


def run_files(spark, tmp_path, batches, **options):
    """Land one file per batch, running the query to its end after each."""
    source, output, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    for place, lines in enumerate(batches):
        (tmp_path / "in" / f"{place}.jsonl").write_text("\n".join(lines) + "\n")
        flows = sources.event_stream(spark, source)
        name = f"w{place}-{tmp_path.name[-20:]}"
        query = queries.start_windows(flows, passed_through, output=output, checkpoint=checkpoint, name=name, **options)
        query.awaitTermination()
    current = sinks.StateTable(output).read(spark)
    return {(r.source_ip, r.window_start.minute * 60 + r.window_start.second): r.flow_count for r in current.collect()}, query


def test_window_state_equals_the_batch_result(spark, tmp_path):
    batches = [
        [event("1", 1), event("2", 4), event("3", 4, "s2"), event("4", 11), event("x", 5, lab_mode="training")],
        [event("5", 12), event("6", 8, destination_port=22)],
    ]
    found, query = run_files(spark, tmp_path, batches)
    assert found == {("s1", 0): 3.0, ("s2", 0): 1.0, ("s1", 10): 2.0}
    from flowsight.operators.windows import recorded_flows
    from flowsight.sources.readers import read_events

    batch = window_features(recorded_flows(read_events(spark, str(tmp_path / "in")), "live"))
    assert {(r.source_ip, r.window_start.second): r.flow_count for r in batch.collect()} == found
    rows = progress.progress_rows(spark, query.recentProgress)
    assert rows.where("input_rows > 0").count() == 1 and rows.where("input_rows = 0 AND rows_per_second IS NOT NULL").isEmpty()
    newest = sinks.newest_windows(sinks.StateTable(str(tmp_path / "out")).read(spark), 1).collect()
    assert [r.window_start.second for r in newest] == [10]


def test_window_model_scores_the_stream(spark, tmp_path):
    label = (F.col("id") % 2).cast("int")
    shaped = spark.range(40).select(
        label.alias("label"), label.cast("double").alias("port_scan_ratio"), F.lit(0.2).alias("flow_rate"), F.lit(1.0).alias("http_ratio")
    )
    model = features.window_model(trees=2).fit(shaped)
    (tmp_path / "in").mkdir()
    lines = [event("1", 1), event("2", 2), event("3", 3, "s2", destination_port=22), event("4", 4, "s2", destination_port=23)]
    (tmp_path / "in" / "0.jsonl").write_text("\n".join(lines) + "\n")
    paths = dict(input_path=str(tmp_path / "in"), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"))
    query = live.window_stream_job(spark, model=model, threshold=0.5, name="modelled", **paths)
    query.awaitTermination()
    current = sinks.StateTable(paths["output"]).read(spark)
    assert {r.source_ip: r.prediction for r in current.collect()} == {"s1": 0, "s2": 1}
    with pytest.raises(ValueError, match="overlap"):
        live.window_stream_job(spark, model=model, threshold=0.5, name="x", **{**paths, "output": paths["input_path"] + "/o"})


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    batches = [[event("1", 5), event("2", 100)], [event("late", 6), event("soon", 95)]]
    found, _ = run_files(spark, tmp_path, batches)
    assert found == {("s1", 0): 1.0, ("s1", 100): 1.0, ("s1", 90): 1.0}


@pytest.mark.parametrize("unique, count", [(False, 3.0), (True, 2.0)])
def test_repeated_events_count_unless_asked_otherwise(spark, tmp_path, unique, count):
    batches = [[event("1", 1), event("2", 2)], [event("1", 1)]]
    found, _ = run_files(spark, tmp_path, batches, unique_events=unique)
    assert found == {("s1", 0): count}


def test_throughput_rows(spark):
    def report(batch, rows, millis):
        return {"batchId": batch, "timestamp": "t", "numInputRows": rows, "durationMs": {"triggerExecution": millis}, "eventTime": {"watermark": "w"}}

    rows = progress.progress_rows(spark, [report(0, 120, 400), report(1, 0, 50), report(0, 120, 400), report(2, 10, 0)])
    assert [r.rows_per_second for r in rows.collect()] == [pytest.approx(300.0), None, pytest.approx(300.0), None]
    busy = progress.throughput(rows).collect()
    assert [(r.batch_id, r.input_rows) for r in busy] == [(0, 120)]


def test_utc_text(spark):
    row = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("t")).select(queries.utc_text("t").alias("x")).first()
    assert row.x == "1970-01-01T00:00:00.000000+00:00"


@pytest.mark.parametrize("parts", [4, 60])
def test_stream_queries_of_a_table_of_many_files(spark, tmp_path, parts):
    import shutil

    import verify
    from flowsight.plans import live  # noqa: F401
    from tests.conftest import SMALL

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(parts).write.parquet(str(tmp_path / "events.parquet"))
    for name in "lineitem orders documents".split():
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    whole = verify.connect(SMALL)
    for name in ("stream_scores", "stream_summary", "stream_windows", "stream_restart_check"):
        assert verify.compare(spark, whole, name, str(tmp_path)) == "", name


def test_a_landed_batch_of_several_files_is_one_batch_of_the_stream(spark, flows, tmp_path):
    score.lock_model(spark, features.contract_model().fit(flows), str(tmp_path / "lock"), name="lr", threshold=0.5)
    done = live.restart_job(spark, flows, str(tmp_path / "job"), lock_path=str(tmp_path / "lock"), name="files", size=4, task_rows=2)
    files = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "job" / "landed"))
    assert files.select(F.input_file_name()).distinct().count() == 6
    assert done["check"].first().asDict() == {"rows": 12, "distinct_ids": 12, "duplicate_ids": 0, "batches": 3, "consecutive": True}
