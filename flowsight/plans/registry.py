"""Named queries: every operator on the given tables, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.functions.hashing import portable_bucket, portable_key
from flowsight.operators import (
    alerts,
    canonical,
    checks,
    clean,
    evaluate,
    features,
    profile,
    quality,
    ranges,
    reconcile,
    sample,
    split,
    train,
    windows,
)
from flowsight.plans import tables
from flowsight.plans.tables import table
from flowsight.session import scratch_path, written
from flowsight.sources import manifest, readers
from flowsight.streaming import sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = 86_400


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, as sums of doubles vary with the order of addition."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({name: F.round(name, digits) for name in names})


def zoneless(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# --- profile ---------------------------------------------------------------------------------


def status_totals(lines: DataFrame) -> DataFrame:
    return profile.representative(
        lines, label="label", group="l_linestatus", sums={"quantity": "quantity", "line_numbers": "line_number"}
    )


def returned_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_linestatus",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
    )


@query
def representative_agg(spark, folder):
    return status_totals(returned_lines(table(spark, folder, "lineitem")))


@query
def class_totals(spark, folder):
    orders = table(spark, folder, "orders")
    return rounded(profile.class_totals(orders, group="o_orderstatus", amount="o_totalprice"), 2)


@query
def class_share(spark, folder):
    return profile.class_share(tables.line_rows(spark, folder))


@query
def category_share(spark, folder):
    return profile.category_share(table(spark, folder, "documents"), "source", 15)


@query
def rate_by_protocol(spark, folder):
    return profile.positive_rate(tables.line_rows(spark, folder), "dur", 15)


@query
def rate_by_service(spark, folder):
    return profile.positive_rate(tables.line_rows(spark, folder), "service", 15)


@query
def rate_by_state(spark, folder):
    return profile.positive_rate(tables.line_rows(spark, folder), "state", 15)


@query
def numeric_profile(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    averages = {"avg_quantity": "l_quantity", "avg_price": "l_extendedprice", "avg_tax": "l_tax"}
    return profile.numeric_profile(lines, averages=averages, medians={"median_discount": "l_discount"})


@query
def exact_medians(spark, folder):
    return profile.exact_medians(table(spark, folder, "lineitem"), "l_extendedprice", "l_returnflag")


@query
def label_correlations(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("label", (F.col("l_extendedprice") > 50_000).cast("int"))
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
    return rounded(profile.label_correlations(lines, columns, 5))


@query
def imbalance(spark, folder):
    return rounded(profile.imbalance(tables.line_rows(spark, folder)))


@query
def table_summary(spark, folder):
    return profile.table_summary(tables.line_rows(spark, folder))


# --- quality, cleaning, canonical rows -------------------------------------------------------


@query
def null_counts(spark, folder):
    return quality.null_counts(tables.labelled_documents(spark, folder))


@query
def value_counts(spark, folder):
    return quality.value_counts(table(spark, folder, "documents"), "lang")


@query
def distinct_counts(spark, folder):
    return quality.distinct_counts(table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag"])


@query
def duplicate_count(spark, folder):
    digests = table(spark, folder, "documents").select(F.sha2("text", 256).alias("digest"))
    return quality.duplicate_count(digests)


@query
def label_audit(spark, folder):
    return quality.label_audit(tables.labelled_documents(spark, folder), "toxic")


@query
def source_counts(spark, folder):
    return quality.source_counts(tables.labelled_documents(spark, folder), "source", "toxic")


@query
def count_reconciliation(spark, folder):
    orders = table(spark, folder, "orders").agg(F.count(F.lit(1))).first()[0]
    return quality.count_reconciliation(table(spark, folder, "lineitem"), verified_rows=4 * orders, published_rows=4 * orders - 3)


@query
def validation_report(spark, folder):
    lines = tables.line_rows(spark, folder)
    expected = table(spark, folder, "lineitem").agg(F.count(F.lit(1))).first()[0]
    return quality.validation_report(lines, tables.LINES, expected_rows=expected)


@query
def cleaning_audit(spark, folder):
    return quality.cleaning_audit(tables.line_rows(spark, folder), tables.LINES)


@query
def clean_rows(spark, folder):
    return clean.clean_rows(tables.line_rows(spark, folder), tables.LINES)


@query
def audit_after_cleaning(spark, folder):
    cleaned = clean.clean_rows(tables.line_rows(spark, folder), tables.LINES)
    return quality.cleaning_audit(cleaned, tables.LINES)


@query
def key_audit(spark, folder):
    documents = tables.labelled_documents(spark, folder)
    keyed = documents.select(F.sha2("text", 256).alias("flow_fingerprint"), F.col("quality").alias("label"))
    return quality.key_audit(keyed)


@query
def conflict_free(spark, folder):
    return clean.without_conflicts(tables.line_labels(spark, folder), "l_orderkey")


@query
def conflict_rows(spark, folder):
    return clean.only_conflicts(tables.line_labels(spark, folder), "l_orderkey")


@query
def single_label_rows(spark, folder):
    documents = tables.labelled_documents(spark, folder)
    keyed = documents.select("doc_id", F.sha2("text", 256).alias("fingerprint"), F.col("quality").alias("label"))
    return clean.single_label_rows(keyed, "fingerprint")


@query
def canonical_rows(spark, folder):
    rows = canonical.canonical_rows(tables.page_tokens(spark, folder), contract=tables.PAGES, layout=tables.PAGE_TOKENS)
    return rows.drop("id").withColumns({c: F.array_join(c, ",") for c in ("malformed_fields", "missing_fields")})


@query
def token_audit(spark, folder):
    rows = canonical.canonical_rows(tables.page_tokens(spark, folder), contract=tables.PAGES, layout=tables.PAGE_TOKENS)
    return quality.token_audit(rows, tables.PAGE_TOKENS)


# --- samples and splits ----------------------------------------------------------------------


@query
def hash_sample(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("bigint")
    return sample.hash_sample(orders, "o_orderstatus", key, [F.col("o_orderkey")], 3_000)


@query
def first_per_group(spark, folder):
    orders = table(spark, folder, "orders")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return sample.first_per_group(orders.drop("o_orderdate"), "o_orderpriority", order, 20)


@query
def balanced_sample(spark, folder):
    lines = tables.line_features(spark, folder)
    return sample.balanced_sample(lines, identifier="id", label="label", per_label=100, key=portable_key("id"))


@query
def seeded_sample(spark, folder):
    lines = tables.line_features(spark, folder)
    return sample.seeded_sample(lines, identifier="id", label="label", limit=12_000, seed=42, key=portable_key("id"))


@query
def holdout_counts(spark, folder):
    orders = table(spark, folder, "orders")
    part = split.holdout_part("o_orderkey", fraction=0.2, seed=42, bucket=portable_bucket)
    return split.split_counts(orders.withColumn("split", part), "o_orderstatus")


@query
def keyed_split(spark, folder):
    return split.keyed_split(tables.line_labels(spark, folder), "l_orderkey", bucket=portable_bucket)


@query
def keyed_split_check(spark, folder):
    """The split by the default hash: no key in two parts, no row lost."""
    lines = clean.single_label_rows(tables.line_labels(spark, folder), "l_orderkey")
    total = lines.agg(F.count(F.lit(1))).first()[0]
    return split.split_check(lines.withColumn("split", split.keyed_part("l_orderkey")), "l_orderkey", total_rows=total)


@query
def shared_keys(spark, folder):
    train_rows, held = split.holdout_split(tables.line_labels(spark, folder), "l_orderkey", fraction=0.2, seed=42)
    return split.shared_keys(train_rows, held, "l_orderkey")


@query
def run_split(spark, folder):
    return split.run_split(tables.order_runs(spark, folder))


@query
def training_mode(spark, folder):
    return split.training_mode(tables.order_runs(spark, folder))


@query
def experiment_check(spark, folder):
    labelled = labelled_day_windows(spark, folder)
    part = F.when(F.dayofmonth("window_start") <= 18, "train").when(F.dayofmonth("window_start") <= 24, "validation")
    counts = labelled.withColumn("split", part.otherwise("test")).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("windows")
    )
    return split.experiment_check({"train": "first", "validation": "second", "test": "third"}, counts)


# --- evaluation and alerts -------------------------------------------------------------------


@query
def confusion(spark, folder):
    return evaluate.confusion(tables.scored_events(spark, folder))


def event_curve(spark, folder):
    return evaluate.threshold_curve(tables.scored_events(spark, folder), score="attack_probability")


@query
def threshold_curve(spark, folder):
    return rounded(event_curve(spark, folder), 9)


@query
def best_threshold(spark, folder):
    return rounded(evaluate.best_threshold(event_curve(spark, folder)), 9)


@query
def most_sensitive_threshold(spark, folder):
    return rounded(evaluate.most_sensitive_threshold(event_curve(spark, folder)), 9)


@query
def ranking_measures(spark, folder):
    return rounded(evaluate.ranking_measures(tables.scored_events(spark, folder), raw="attack_probability"))


@query
def exact_ranking_measures(spark, folder):
    """The same over scores that are hardly ever equal."""
    events = table(spark, folder, "events").select(
        (F.col("event_type") == "error").cast("int").alias("label"), (F.col("value") / (F.col("value") + 50.0)).alias("score")
    )
    return rounded(evaluate.ranking_measures(events, raw="score"))


@query
def class_weights(spark, folder):
    return rounded(train.class_weights(tables.line_rows(spark, folder)), 9)


@query
def outcome_rows(spark, folder):
    events = tables.scored_events(spark, folder)
    cells = ("true_positive", "false_positive", "true_negative", "false_negative")
    return readers.union_all([
        alerts.outcome_rows(events, cell).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(cell).alias("outcome"), "rows") for cell in cells
    ])


@query
def top_alerts(spark, folder):
    return alerts.top_alerts(tables.scored_events(spark, folder), 200)


@query
def top_false_positives(spark, folder):
    return alerts.top_false_positives(tables.scored_events(spark, folder), 50)


@query
def lowest_false_negatives(spark, folder):
    return alerts.lowest_false_negatives(tables.scored_events(spark, folder), 50)


@query
def outcome_examples(spark, folder):
    return alerts.outcome_examples(tables.scored_events(spark, folder))


@query
def alert_distribution(spark, folder):
    return rounded(alerts.alert_distribution(tables.scored_events(spark, folder), "user_id"))


@query
def best_candidate(spark, folder):
    """Three scores for the same events, measured at their best thresholds, and the best of them."""
    events = tables.scored_events(spark, folder)
    scores = {
        "value": F.col("attack_probability"),
        "inverse": 1 - F.col("attack_probability"),
        "kind": F.when(F.col("event_type").isin("error", "signup"), 0.8).otherwise(0.2),
    }
    reports = []
    for name, score in scores.items():
        curve = evaluate.threshold_curve(events.withColumn("score", score), score="score")
        extra = {"name": F.lit(name), "predict_seconds": F.lit(0.0), "fit_seconds": F.lit(0.0)}
        reports.append(evaluate.best_threshold(curve).withColumns(extra))
    chosen = train.best_candidate(readers.union_all(reports))
    return rounded(chosen.select("name", "threshold", "f1", "recall", "false_positive_rate"), 9)


# --- windows and reconciliation --------------------------------------------------------------


def day_windows(spark, folder):
    flows = tables.flow_events(spark, folder).where(F.col("record_type") == "flow")
    return windows.window_features(flows, seconds=DAY)


def labelled_day_windows(spark, folder):
    truth = tables.event_truth(spark, folder).select("event_id", "label")
    return windows.labelled_windows(tables.flow_events(spark, folder), truth, seconds=DAY)


def ruled_windows(spark, folder):
    ruled = windows.rule_score(day_windows(spark, folder))
    return ruled.withColumn("prediction", (F.col("rule_score") >= 0.5).cast("int"))


@query
def window_features(spark, folder):
    return zoneless(rounded(day_windows(spark, folder)))


@query
def short_window_features(spark, folder):
    """The windows of ten seconds, for events of every record type."""
    return zoneless(rounded(windows.window_features(tables.flow_events(spark, folder))))


@query
def session_features(spark, folder):
    return rounded(windows.session_features(tables.flow_events(spark, folder)))


@query
def complete_sessions(spark, folder):
    return rounded(windows.complete_sessions(tables.flow_events(spark, folder), tables.run_truth(spark, folder)))


@query
def labelled_windows(spark, folder):
    return zoneless(rounded(labelled_day_windows(spark, folder)))


@query
def rule_measures(spark, folder):
    """The rule baseline measured on the labelled windows."""
    ruled = windows.rule_score(labelled_day_windows(spark, folder))
    return rounded(evaluate.measure_at(ruled, 0.5, score="rule_score"), 9)


@query
def challenge_measures(spark, folder):
    """A rule on complete sessions, measured on the mode that is kept out of training."""
    sessions = windows.complete_sessions(tables.flow_events(spark, folder), tables.run_truth(spark, folder))
    ruled = sessions.withColumn("score", 1 - F.col("http_ratio"))
    return rounded(evaluate.challenge_measures(ruled, 0.5, score="score"), 9)


def reconciled_windows(spark, folder):
    flows = tables.flow_events(spark, folder)
    # the watermark trails the last event by two days, so the last windows are not final yet
    watermark = flows.agg(F.max("timestamp") - F.expr("interval 2 days")).scalar()
    truth = tables.event_truth(spark, folder)
    return reconcile.reconcile(ruled_windows(spark, folder), truth, watermark=watermark, seconds=DAY)


@query
def reconciled(spark, folder):
    columns = ["source_ip", "window_start", "flow_count", "prediction", "checked", "outcome", "actual"]
    return zoneless(reconciled_windows(spark, folder).select(*columns))


@query
def outcome_counts(spark, folder):
    return reconcile.outcome_counts(reconciled_windows(spark, folder))


@query
def windows_per_source(spark, folder):
    return reconcile.windows_per_source(day_windows(spark, folder))


@query
def latest_windows(spark, folder):
    newest = reconcile.latest_windows(ruled_windows(spark, folder))
    return zoneless(newest.select("actor_id", "source_ip", "window_start", "flow_count", "prediction"))


@query
def numbered_windows(spark, folder):
    numbered = reconcile.numbered_windows(written(day_windows(spark, folder), "day-windows"))
    return zoneless(numbered.select("actor_id", "window_start", "flow_count", "window_number"))


# --- equality of results and files -----------------------------------------------------------


@query
def partition_invariance(spark, folder):
    """The aggregate over the lines dealt out in three ways, all rows of each."""
    parallel = spark.sparkContext.defaultParallelism
    lines = returned_lines(table(spark, folder, "lineitem"))
    return checks.with_verdict({f"{times} x cores": status_totals(lines.repartition(times * parallel)) for times in (1, 2, 4)})


@query
def format_equivalence(spark, folder):
    """The same aggregate over Parquet and over a CSV copy of the needed columns, read anew and held in memory."""
    lines = returned_lines(table(spark, folder, "lineitem"))
    path = scratch_path(spark, "lines-csv")
    lines.write.option("header", True).csv(path)
    copy = readers.read_csv_header(spark, path, lines.schema)
    return checks.with_verdict(checks.read_and_kept({"parquet": lines, "csv": copy}, status_totals))


@query
def rank_slice(spark, folder):
    """Lines 20 % to 45 % of the way through an order by a column of few values."""
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_orderkey", "l_linenumber")
    total = lines.count()
    return ranges.rank_slice(lines, ["l_quantity", "l_orderkey", "l_linenumber"], total // 5, total * 9 // 20, rows=total // 50 + 1)


@query
def landed_events(spark, folder):
    """The fourth and the first landed batch of the events in an order by type, one after the other."""
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    path, size = scratch_path(spark, "landed"), events.count() // 7
    for index in (3, 0):
        sources.land_batch(events, path, index, size, order=["event_type", "event_id"], task_rows=size // 3 + 1)
    parts = [spark.read.parquet(f"{path}/batch-{index:05d}").withColumn("batch", F.lit(index)) for index in (0, 3)]
    return readers.union_all(parts)


@query
def one_per_key(spark, folder):
    """One event of each user and type: the least by the other columns in their order."""
    events = table(spark, folder, "events").select(F.concat_ws("/", "user_id", "event_type").alias("key"), "value", "event_id")
    return clean.one_per_key(events, "key")


@query
def wide_columns(spark, folder):
    """Which text columns of the orders and events have too many values to be indexed."""
    orders = table(spark, folder, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("o_key"), "o_orderpriority")
    wide = features.wide_columns(orders, orders.columns, 100)
    return spark.createDataFrame([(name, name in wide) for name in orders.columns], "column_name string, hashed boolean")


@query
def file_manifest(spark, folder):
    return manifest.file_manifest(spark, folder, pattern="*.parquet")


@query
def file_audit(spark, folder):
    """Every file of the tables against a list with one size changed, one name missing and one too many."""
    found = written(manifest.file_manifest(spark, folder, pattern="*.parquet"), "manifest")
    named = F.element_at(F.split("name", "/"), 1)
    wrong = F.when(named == "orders.parquet", 1).otherwise(0)
    listed = found.where(named != "nation.parquet").select("name", (F.col("bytes") + wrong).alias("bytes"), "md5")
    listed = listed.unionByName(spark.createDataFrame([("none.parquet", 1, "")], "name string, bytes bigint, md5 string"))
    audit = manifest.audit_manifest(found, listed)
    return audit.select(F.element_at(F.split("name", "/"), 1).alias("table_file"), "status").distinct()
