"""Named queries that run whole jobs over the given tables: files written, read back, cleaned, scored and landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.contract import Contract
from flowsight.functions.hashing import portable_bucket
from flowsight.operators import alerts, canonical, clean, features, quality, score, split, train, windows
from flowsight.plans import batch, learning, live, tables
from flowsight.plans.registry import query, rounded
from flowsight.session import scratch_path, written
from flowsight.sources import readers, sinks

# The writer would cut off blanks, which cleaning is to find.
KEEP_BLANKS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def bronze_of(rows: DataFrame, contract: Contract) -> tuple[batch.Stored, str]:
    spark = rows.sparkSession
    path = scratch_path(spark, "bronze-jobs")
    rows.write.options(**KEEP_BLANKS).csv(f"{path}/raw")
    return batch.bronze_job(spark, f"{path}/raw", f"{path}/bronze", expected_rows=rows.count(), contract=contract), path


@query
def bronze_lines(spark, folder):
    """Order lines through strict CSV into checked Parquet."""
    return bronze_of(tables.line_rows(spark, folder), tables.LINES)[0].rows


@query
def bronze_validation(spark, folder):
    """The validation report of the stored lines."""
    return bronze_of(tables.line_rows(spark, folder), tables.LINES)[0].reports["validation"]


@query
def silver_orders(spark, folder):
    """Orders through strict CSV, cleaned, with a clean audit afterwards."""
    _, path = bronze_of(tables.order_rows(spark, folder), tables.ORDERS)
    return batch.silver_job(spark, f"{path}/bronze", f"{path}/silver", contract=tables.ORDERS).rows


@query
def json_sessions(spark, folder):
    """Events and run truth as JSON lines in folders, and the complete sessions of them."""
    path = scratch_path(spark, "json-events")
    flows = tables.flow_events(spark, folder)
    late = F.col("timestamp") >= F.lit("2024-01-01").cast("timestamp")
    for name, part in (("late", flows.where(late)), ("early", flows.where(~late))):
        part.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).write.json(f"{path}/{name}")
    tables.run_truth(spark, folder).write.json(f"{path}/truth")
    events = readers.read_events(spark, [f"{path}/late", f"{path}/early"])
    return rounded(windows.complete_sessions(events, readers.read_run_truth(spark, f"{path}/truth")))


@query
def raw_file_rows(spark, folder):
    """Page tokens as headerless text files, read by name and made canonical: what the files of each part give."""
    path = scratch_path(spark, "raw-pages")
    tokens = tables.page_tokens(spark, folder).drop("source_file").withColumn("part", (F.col("label") == "1").cast("int"))
    for part in (0, 1):
        tokens.where(F.col("part") == part).drop("part").write.csv(f"{path}/part-{part}")
    counts = []
    for part in (0, 1):
        found = spark.read.format("binaryFile").load(f"{path}/part-{part}").select("path").collect()
        names = [row.path.rsplit("/", 1)[1] for row in found]
        rows = canonical.canonical_rows(
            readers.read_raw_files(spark, f"{path}/part-{part}", names, tables.PAGE_TOKENS), contract=tables.PAGES, layout=tables.PAGE_TOKENS
        )
        of_files = quality.source_counts(rows).groupBy(F.lit(part).alias("part"))
        counts.append(of_files.agg(*[F.sum(name).alias(name) for name in ("rows", "invalid_label_rows")]))
    return readers.union_all(counts)


@query
def csv_report(spark, folder):
    """The top alerts as a single CSV file, read back."""
    path = scratch_path(spark, "alert-report")
    top = alerts.top_alerts(tables.scored_events(spark, folder), 200)
    sinks.write_csv_report(top, path)
    return readers.read_csv_header(spark, path, top.schema)


@query
def alert_tables(spark, folder):
    """The stored tables of an alert report: rows of each, and the sum of their scores."""
    events = tables.scored_events(spark, folder)
    stored = batch.alert_job(events, scratch_path(spark, "alerts"), events.columns, groups=["event_type"])
    scores = {"alert_distribution": "mean_score", "measures": "f1"}
    return rounded(readers.union_all([
        df.agg(F.count(F.lit(1)).alias("rows"), F.sum(scores.get(name, "attack_probability")).alias("total_score")).select(
            F.lit(name).alias("report"), "rows", "total_score"
        )
        for name, df in stored.items()
    ]))


def locked_on_lines(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """A logistic regression on the order lines, locked below the path; returns the lines."""
    rows = tables.line_features(spark, folder)
    training, _ = split.holdout_split(rows, "id", fraction=0.2, seed=42, bucket=portable_bucket)
    model = features.fit_on_vectors(written(training, "training"), tables.LINE_FEATURES, features.logistic(max_iter=15))
    score.lock_model(spark, model, path, name="logistic", threshold=0.5)
    return rows


@query
def batch_scores_check(spark, folder):
    """All lines scored into Parquet and CSV by a locked model, and the held-out ones tested once."""
    path = scratch_path(spark, "batch-scores")
    rows = locked_on_lines(spark, folder, f"{path}/model")
    model, lock = score.load_locked(spark, f"{path}/model")
    saved = score.score_batch(rows, model, lock, f"{path}/scores", run_id="run", scored_at="now", csv=True)
    copy = readers.read_csv_header(spark, f"{path}/scores/csv", saved.schema)
    _, held = split.holdout_split(rows, "id", fraction=0.2, seed=42, bucket=portable_bucket)
    tested = train.test_once(model, held, lock.decision_threshold, f"{path}/test")
    figures = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives"), (F.avg(F.col("is_correct").cast("int")) >= 0.9).alias("mostly_right"))
        .select(F.lit(name).alias("part"), "*")
        for name, df in (("parquet", saved), ("csv", copy))
    ]
    right = (F.col("tp") + F.col("tn")) >= 0.9 * F.col("total")
    figures.append(tested.select(F.lit("test").alias("part"), F.col("total").alias("rows"), (F.col("tp") + F.col("fn")).alias("positives"), right.alias("mostly_right")))
    return readers.union_all(figures)


@query
def full_training_check(spark, folder):
    """Fit on one part of the lines, threshold on the second, the third scored once: its rows by label and outcome."""
    rows = tables.line_features(spark, folder).withColumn("split", split.keyed_part("id", bucket=portable_bucket))
    path = scratch_path(spark, "full-training")
    saved = split.save_split(rows, f"{path}/split")
    lock, scored, measures = learning.full_training_job(saved, path, tables.LINE_FEATURES, max_iter=15)
    known = F.lit(lock.decision_threshold).isin([F.lit(threshold) for threshold in learning.evaluate.THRESHOLDS])
    found = scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction") == (F.col("attack_score") >= lock.decision_threshold).cast("int")).alias("decided_rows"),
        (F.avg((F.col("prediction") == F.col("label")).cast("int")) >= 0.9).alias("mostly_right"),
    )
    total = measures.select("total").scalar()
    return found.select("*", known.alias("threshold_of_grid"), total.alias("measured_rows"))


@query
def restart_job_check(spark, folder):
    """Orders landed by rank, scored, more of them landed, and the query started again from its checkpoint."""
    path = scratch_path(spark, "restart-job")
    rows = written(clean.clean_rows(tables.order_rows(spark, folder), tables.ORDERS), "orders")
    model = features.fit_on_vectors(rows, tables.ORDERS, features.logistic(max_iter=2))
    score.lock_model(spark, model, f"{path}/model", name="logistic", threshold=0.5)
    size = rows.count() // 20
    done = live.restart_job(spark, rows, f"{path}/job", lock_path=f"{path}/model", name=f"restart-{path[-32:]}", size=size, order=("id", "label"))
    figures = done["progress"].agg(F.sum("input_rows").alias("input_rows"), F.count_distinct("run_id").alias("runs"), F.sum("late_rows").alias("late_rows"))
    ends = done["scores"].agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return done["check"].select(
        "*", *[figures.select(name).scalar().alias(name) for name in figures.columns],
        *[ends.select(name).scalar().cast("bigint").alias(name) for name in ends.columns],
    )
