"""Hot keys and sizes: results stay whole, and plans keep their shape."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowsight.contract import EVENT_TRUTH_SCHEMA, FLOW, FLOW_EVENT_SCHEMA, Contract, ddl
from flowsight.operators import clean, evaluate, features, quality, ranges, reconcile, split, windows
from flowsight.plans import registry, tables
from flowsight.session import build_session, scratch_path, spread, written
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows; it has one label, the next key has two."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, "clash").otherwise(F.concat(F.lit("k"), "id"))
    label = F.when(F.col("id") % 3 == 0, 1).otherwise((F.floor(F.col("id") / 1000) % 2).cast("int"))
    return spark.range(30_000).select("id", key.alias("k"), label.alias("label"))


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_conflicts_with_and_without_broadcast(spark, hot, plan_of, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        kept, dropped = clean.without_conflicts(hot, "k"), clean.only_conflicts(hot, "k")
        assert ("BroadcastHashJoin" in plan_of(kept)) == (threshold != "-1")
        assert kept.columns == hot.columns
        clashes = hot.where("k = 'clash'").count()
        assert dropped.count() == clashes and kept.count() == 30_000 - clashes
        assert kept.where("k = 'hot'").count() == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_audit_and_split(hot):
    audit = quality.key_audit(hot, "k").first()
    assert (audit.rows, audit.conflicting_keys) == (30_000, 1)
    parts = split.keyed_split(hot, "k")
    assert parts.where("k = 'hot'").select("split").distinct().count() == 1
    assert split.split_check(parts, "k").first().shared_keys == 0


def test_hot_window_and_hot_truth(spark):
    """A third of the flows fall into one window, and one event's truth is repeated many times."""
    columns = {
        "event_id": F.col("id").cast("string"), "actor_id": F.lit("a"), "experiment_id": F.lit("e"), "record_type": F.lit("flow"),
        "lab_mode": F.lit("live"), "source_ip": F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")),
        "timestamp": F.date_format(F.timestamp_seconds(1_767_225_600 + F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 100)), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "destination_port": F.lit(8080), "sbytes": F.col("id"), "dbytes": F.lit(1).cast("bigint"), "dur": F.lit(1.0), "service": F.lit("http"),
    }
    names = FLOW_EVENT_SCHEMA.fieldNames()
    flows = spark.range(9_000).select(*[columns.get(n, F.lit(None).cast(FLOW_EVENT_SCHEMA[n].dataType)).alias(n) for n in names])
    found = windows.window_features(flows)
    assert found.agg(F.sum("flow_count")).first()[0] == 9_000
    assert found.where("source_ip = 'hot'").first().flow_count == 3_000
    truth = flows.select("event_id", F.lit(0).alias("label"))
    repeated = truth.unionByName(spark.createDataFrame([("0", 0)] * 3_000, EVENT_TRUTH_SCHEMA))
    labelled = windows.labelled_windows(flows, truth)
    again = windows.labelled_windows(flows, repeated)
    assert labelled.where("source_ip = 'hot'").count() == 1
    assert again.where("source_ip = 'hot'").count() == 0
    assert again.count() == labelled.count() - 1
    assert reconcile.latest_windows(found).count() == 1


def test_events_are_hash_aggregated_before_anything_is_sorted(spark, plan_of):
    lines = plan_of(windows.window_features(tables.flow_events(spark, SMALL))).splitlines()
    deepest = [line for line in lines if "Aggregate(" in line][-1]
    assert "HashAggregate" in deepest


def test_no_query_crosses_tables(spark, plan_of):
    for name in ("threshold_curve", "class_share", "category_share", "best_threshold", "reconciled", "partition_invariance"):
        plan = plan_of(registry.QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_read_only_what_they_need(spark, plan_of):
    assert "FileScan parquet [l_linenumber" in plan_of(registry.representative_agg(spark, SMALL)) and "l_extendedprice" not in plan_of(
        registry.representative_agg(spark, SMALL)
    )
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_returnflag), GreaterThan(l_orderkey,0)" in plan_of(
        registry.clean_rows(spark, SMALL)
    )
    assert "TakeOrderedAndProject" in plan_of(registry.top_alerts(spark, SMALL))


def test_curve_does_not_multiply_rows_by_thresholds(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 1000).alias("s"))
    grid = [i / 300 for i in range(1, 300)]
    curve = evaluate.threshold_curve(df, grid, score="s")
    assert curve.count() == 299 and "Join" in plan_of(curve) and "Expand" not in plan_of(curve)
    row = curve.where("abs(threshold - 0.5) < 1e-9").first()
    assert (row.tp, row.fp, row.tn, row.fn) == (250, 250, 250, 250)


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:1"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="shared folder"):
        scratch_path(Session(), "x")


def test_local_session_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr("flowsight.session.CHECKPOINT_KEY", "spark.flowsight.unset")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_spread_follows_from_the_rows_alone(spark):
    def placed(df):
        parts = spread(df, divisor=30).withColumn("part", F.spark_partition_id())
        return parts.withColumn("place", F.monotonically_increasing_id()).orderBy("id").collect()

    few = placed(spark.range(0, 10_000, 1, 1))
    assert few == placed(spark.range(0, 10_000, 1, 7).orderBy(F.desc("id")))
    assert {row.part for row in few} == {0, 1, 2, 3}


def test_a_slice_is_read_from_its_written_ranges(spark, tmp_path):
    """The ranges of the rows are found once: neither the result nor later cuts read the table again."""
    spark.range(3_000).selectExpr("id % 7 AS k", "id").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = ranges.rank_slice(rows, ["k", "id"], 700, 1_900, rows=60)
    assert not [name for name in found.inputFiles() if str(tmp_path) in name]
    assert sorted(map(tuple, found.collect())) == sorted((i % 7, i) for i in range(3_000))[700:1_900]
    for start, stop in ((0, 3_000), (5, 5), (2_990, 3_500), (4_000, 5_000)):
        assert ranges.rank_slice(rows, ["k", "id"], start, stop, rows=60).count() == max(0, min(stop, 3_000) - start)


def test_session_defaults(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


# --- ranges -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Half of the rows have one value of the order column, and 900 rows are equal in everything."""
    rng = random.Random(2)
    rows = [(None if rng.random() < 0.05 else 7 if rng.random() < 0.5 else rng.randrange(1_000), rng.choice(["a", "b", None]), rng.randrange(4)) for _ in range(5_000)]
    path = str(tmp_path_factory.mktemp("skewed") / "rows")
    spark.createDataFrame(rows + [(7, "a", 1)] * 900, "k int, s string, v int").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def in_order(skewed):
    tie = F.xxhash64("k", "s", "v")
    return [tuple(row) for row in skewed.orderBy(F.asc_nulls_first("k"), F.asc_nulls_first("s"), tie, "v").collect()]


@pytest.mark.parametrize(("start", "stop"), [(0, 10), (2_500, 2_600), (100, 4_000), (5_890, 6_000), (0, 5_900), (3_000, 3_000), (9_000, 9_001)])
def test_slices_of_a_skewed_order(skewed, in_order, start, stop):
    got = ranges.rank_slice(skewed, ["k", "s"], start, stop, rows=100)
    assert Counter(tuple(row) for row in got.collect()) == Counter(in_order[start:stop])


def test_ranges_are_small_ordered_and_whole(skewed, spark):
    keyed = skewed.withColumn(ranges.KEY, ranges.total_order(skewed, ["k", "s"]))
    ranged, counts = ranges.adaptive_ranges(keyed, rows=150)
    equal = ranges.of_equal_rows()
    found = counts.withColumn("equal", equal).collect()
    assert sum(row["rows"] for row in found) == 5_900 and len(found) > 40
    assert max(row["rows"] for row in found if not row.equal) <= 150 and max(row["rows"] for row in found) >= 900
    ends = ranged.groupBy(ranges.RANGE).agg(F.min(ranges.KEY).alias("low"), F.max(ranges.KEY).alias("high"), F.count_distinct(ranges.KEY).alias("keys"))
    ends = sorted(ends.withColumn("equal", equal).collect(), key=lambda row: row[ranges.RANGE])
    place = Window.orderBy(ranges.KEY)
    ranks = {row[ranges.KEY]: row["rank"] for row in keyed.select(ranges.KEY, F.rank().over(place).alias("rank")).distinct().collect()}
    assert all(ranks[a.high] < ranks[b.low] for a, b in zip(ends, ends[1:]))
    assert all(row["keys"] == 1 for row in ends if row.equal)
    # groups are cut each for itself
    grouped, sizes = ranges.adaptive_ranges(keyed, ["s"], rows=400)
    assert sizes.groupBy("s").agg(F.sum("rows").alias("n")).agg(F.sum("n")).first()[0] == 5_900
    assert sizes.where(~equal).agg(F.max("rows")).first()[0] <= 400


def test_a_late_slice_costs_what_the_first_does(skewed, spark):
    def jobs(start):
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"slice-{start}", "slice")
        ranges.rank_slice(skewed, ["k", "s"], start, start + 50, rows=200).count()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"slice-{start}"))

    assert jobs(5_300) <= 2 * jobs(0)


def test_numbers_of_a_source_with_all_windows_on_one_day(spark):
    start = F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") % 40)
    rows = spark.range(900).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("actor_id"), start.alias("window_start"), "id")
    numbered = reconcile.numbered_windows(written(rows, "windows"), rows=50).collect()
    by_source = {}
    for row in numbered:
        by_source.setdefault(row.actor_id, []).append((row.window_number, row.window_start))
    assert len(by_source["hot"]) == 600 and len(numbered) == 900
    for own in by_source.values():
        assert [number for number, _ in sorted(own)] == list(range(1, len(own) + 1))
        assert [at for _, at in sorted(own)] == sorted(at for _, at in own)


@pytest.mark.parametrize("rows", [7, 1_000_000])
def test_areas_in_ranges_of_any_size(spark, rows):
    df = spark.range(3_000).select((F.col("id") % 3 == 0).cast("int").alias("label"), ((F.col("id") * 7_919) % 997 / 997.0).alias("s"))
    whole = evaluate.ranking_measures(df, raw="s").first()
    cut = evaluate.ranking_measures(df.where("s < 0.05 OR s > 0.9"), raw="s", rows=rows).first()
    same = evaluate.ranking_measures(df.where("s < 0.05 OR s > 0.9"), raw="s").first()
    assert cut.roc_auc == pytest.approx(same.roc_auc, abs=1e-12) and cut.pr_auc == pytest.approx(same.pr_auc, abs=1e-12)
    assert 0 < whole.roc_auc < 1


# --- rows as digests --------------------------------------------------------------------------


def test_audits_shuffle_digests_and_not_rows(spark, plan_of, flow_row):
    rows = spark.createDataFrame([flow_row(id=1), flow_row(id=1), flow_row(id=2, dur=None)], FLOW.schema)

    def shuffled(df):
        """The columns that go through each exchange by a key."""
        return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line]

    for audit in (quality.cleaning_audit(rows, FLOW), quality.validation_report(rows, FLOW, expected_rows=3), quality.duplicate_count(rows)):
        assert shuffled(audit) and not any("sbytes" in line for line in shuffled(audit))
        keys = [line for line in plan_of(audit).splitlines() if "HashAggregate(keys=[digest_0" in line]
        assert keys and "SortAggregate" not in plan_of(audit) and all("sbytes#" not in line.split("functions=")[0] for line in keys)
    # cleaning itself is the one place where whole rows move
    assert len(shuffled(clean.clean_rows(rows, FLOW))) == 1


def test_digests_of_rows(spark):
    rows = [(None, 1.0, "a"), (1, None, "a"), (1, float("nan"), None), (1, float("nan"), None), (0, 0.0, ""), (0, -0.0, ""), (0, 0.0, None)]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    row = quality.duplicate_count(df).first()
    assert tuple(row) == (7, df.distinct().count(), 7 - df.distinct().count()) == (7, 5, 2)
    wide = spark.range(40).select(*[(F.col("id") % (place + 2)).alias(f"c{place}") for place in range(130)])
    wide = wide.unionByName(wide.limit(3))
    checks = [F.col(f"c{place}") == 1 for place in range(130)]
    counted = quality.copies(wide, checks=checks)
    found = counted.agg(*[quality.marked_rows(counted, place).alias(str(place)) for place in range(130)]).first()
    assert list(found) == [wide.where(check).count() for check in checks[:5]] + list(found)[5:]
    assert counted.agg(F.sum("copies"), F.max("copies")).first() == (43, 2)


# --- one row of each key ----------------------------------------------------------------------


def test_one_row_of_each_key(spark, plan_of):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None), (None, 3, "n"), (None, 2, "m"), ("c", None, "p"), ("c", 0, "q")]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "event_id string, n int, t string").repartition(parts)
        got = clean.one_per_key(df, "event_id")
        assert got.columns == df.columns
        assert sorted(map(str, (tuple(row) for row in got.collect()))) == sorted(map(str, [("a", 1, "y"), ("b", 5, None), (None, 2, "m"), ("c", None, "p")]))
    assert clean.one_per_key(df.limit(0), "event_id").count() == 0


def test_distinct_events_are_not_sorted(spark, plan_of):
    events = tables.flow_events(spark, SMALL)
    truth = tables.event_truth(spark, SMALL).select("event_id", "label")
    plan = plan_of(windows.windows_with_labels(events, truth))
    lines = plan.splitlines()
    deepest = [place for place, line in enumerate(lines) if "FileScan" in line]
    # whatever sorts does so above an aggregate, or on the few rows of repeated keys
    assert "first(" not in plan and len(deepest) >= 2


# --- columns of very many values --------------------------------------------------------------


def test_wide_text_columns_are_hashed_or_refused(spark):
    contract = Contract(
        schema=ddl("id bigint, proto string, agent string, dur double, attack_cat string, label int"),
        identifier="id", categorical=("proto", "agent"), category="attack_cat", label="label",
    )
    label = (F.col("id") % 2).cast("int")
    rows = spark.range(30_000).select(
        "id", F.concat(F.lit("p"), F.col("id") % 3).alias("proto"), F.concat(F.lit("agent"), "id").alias("agent"),
        (F.col("id") % 5).cast("double").alias("dur"), F.lit("x").alias("attack_cat"), label.alias("label"),
    )
    assert features.wide_columns(rows, contract.categorical) == ("agent",)
    assert features.wide_columns(rows.limit(2_000), contract.categorical) == ()
    with pytest.raises(ValueError, match="more than 10000 distinct values: agent"):
        features.require_narrow(rows, contract.categorical)
    model = features.fit_contract_model(rows, contract)
    kinds = [type(stage).__name__ for stage in model.stages]
    assert kinds[:3] == ["StringIndexerModel", "OneHotEncoderModel", "FeatureHasher"]
    assert sum(len(labels) for labels in model.stages[0].labelsArray) == 3
    size = len(model.transform(rows.limit(1)).first().features)
    assert size == 1 + 5 + features.HASHED_VALUES
    again = features.fit_features(rows, contract, most=100_000)
    assert [type(stage).__name__ for stage in again.stages][:2] == ["StringIndexerModel", "OneHotEncoderModel"]


def test_candidates_are_fitted_side_by_side(spark):
    import threading

    from flowsight.operators import train

    running, most = set(), []
    lock = threading.Lock()

    class Slow:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            with lock:
                running.add(threading.get_ident())
                most.append(len(running))
            both.wait(timeout=60)
            try:
                return self.inner.fit(rows)
            finally:
                with lock:
                    running.discard(threading.get_ident())

    both = threading.Barrier(2)
    rows = spark.range(400).selectExpr("cast(id % 2 as int) AS label", "cast(id % 7 + id % 2 as double) AS flow_rate", "0.5D AS port_scan_ratio", "0.1D AS http_ratio")
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    prepared = Pipeline(stages=[VectorAssembler(inputCols=["flow_rate"], outputCol="features")]).fit(rows)
    ready = written(prepared.transform(rows).select("label", "features"), "ready")
    candidates = [
        train.Candidate("plain", "logistic", Slow(features.logistic(max_iter=5))),
        train.Candidate("weighted", "logistic", Slow(features.logistic(max_iter=5, weight="class_weight")), weighted=True),
    ]
    found = train.fit_all(candidates, prepared, ready, ready)
    assert max(most) == 2 and list(found) == ["plain", "weighted"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    broken = [train.Candidate("broken", "logistic", features.logistic(label="nothing"))]
    with pytest.raises(Exception, match="nothing"):
        train.fit_all(broken, prepared, ready, ready)


# --- work that one task did -------------------------------------------------------------------


def test_raw_pages_are_written_and_counted_by_many_tasks(spark, tmp_path, monkeypatch):
    from flowsight.plans import jobs

    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    settings = {"spark.sql.files.openCostInBytes": str(128 << 20)}
    monkeypatch.setattr(jobs, "scratch_path", lambda *_: str(tmp_path / "raw"))
    spark.conf.set(*settings.popitem())
    try:
        found = {row.part: row["rows"] for row in jobs.raw_file_rows(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((tmp_path / "raw" / "part-0").glob("part-*.csv"))) == 3
    assert sum(found.values()) == spark.read.parquet(str(tmp_path / "pages.parquet")).count()


def test_a_large_csv_copy_has_many_parts(spark, tmp_path, monkeypatch):
    from flowsight.operators import score
    from flowsight.plans import tables

    rows = tables.line_features(spark, "/root/testdata/sf0.001").limit(400).repartition(4)
    model = features.fit_on_vectors(written(rows, "rows"), tables.LINE_FEATURES, features.logistic(max_iter=1))
    score.lock_model(spark, model, str(tmp_path / "lock"), name="lr", threshold=0.5)
    model, lock = score.load_locked(spark, str(tmp_path / "lock"))
    monkeypatch.setattr(score, "CSV_ROWS", 100)
    monkeypatch.setattr(score, "write_checked", lambda df, path, **_: df.repartition(6))
    score.score_batch(rows, model, lock, str(tmp_path / "out"), run_id="r", scored_at="t", csv=True)
    parts = list((tmp_path / "out" / "csv").glob("part-*.csv"))
    assert len(parts) == 4 and spark.read.csv(str(tmp_path / "out" / "csv"), header=True).count() == 400


def test_forests_keep_the_node_of_each_row_and_fit_the_same_trees(spark):
    rows = spark.range(600).selectExpr("cast(id * 7 % 11 > 4 as int) AS label", "id * 7 % 11 * 1.0 + id % 3 AS a", "id % 5 * 1.0 AS b")
    rows = features.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    fast = features.forest(5, 6)
    assert fast.getCacheNodeIds()
    plain = fast.copy().setCacheNodeIds(False)
    trees = lambda forest: forest.fit(rows).toDebugString.split("\n", 1)[1]
    assert trees(fast) == trees(plain)
