import hashlib
import math

import pytest
from pyspark.sql import functions as F

from flowsight.functions.hashing import portable_bucket, row_hash
from flowsight.operators import ranks, sample, split


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(f"k{i}", i % 2) for i in range(1000)] + [("k7", 1), ("both", 0), ("both", 1)]
    return spark.createDataFrame(rows, "flow_fingerprint string, label int")


def test_keyed_split_keeps_copies_together_and_drops_conflicts(keyed):
    parts = split.keyed_split(keyed)
    assert parts.count() == 1001
    assert parts.where(F.col("flow_fingerprint") == "both").isEmpty()
    check = split.split_check(parts, "flow_fingerprint", total_rows=1001).first()
    assert (check.keys, check.shared_keys, check.complete) == (1000, 0, True)
    again = split.keyed_split(keyed.repartition(5).orderBy(F.desc("label"), "flow_fingerprint"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, parts.collect()))


def test_holdout_is_disjoint_complete_and_repeatable(spark):
    rows = spark.range(1, 101)
    options = dict(fraction=0.2, seed=42, buckets=1_000)
    train, validation = (sorted(r.id for r in part.collect()) for part in split.holdout_split(rows, "id", **options))
    assert sorted(train + validation) == list(range(1, 101))
    repeated = split.holdout_split(rows.repartition(7), "id", **options)[1]
    assert sorted(r.id for r in repeated.collect()) == validation
    train_rows, held = split.holdout_split(rows, "id", **options)
    split.require_disjoint(train_rows, held, "id")
    with pytest.raises(ValueError, match="both parts"):
        split.require_disjoint(rows, held, "id")


@pytest.mark.parametrize("options", [{"fraction": 0.0}, {"fraction": 1.0}, {"fraction": 0.2, "buckets": 99}])
def test_holdout_options_are_checked(options):
    with pytest.raises(ValueError):
        split.holdout_part("id", seed=1, **options)


def test_portable_bucket_is_md5(spark):
    found = spark.range(50).select("id", portable_bucket("id", seed=3, buckets=100).alias("b")).collect()
    for row in found:
        assert row.b == int(hashlib.md5(f"{row.id}:3".encode()).hexdigest()[:8], 16) % 100


@pytest.mark.parametrize("n", [5, 6, 17, 400])
def test_run_split_follows_the_hashed_order(spark, n):
    runs = spark.createDataFrame([(f"run-{label}-{i}", label) for label in (0, 1) for i in range(n)], "run_id string, label int")
    found = {r.run_id: r.split for r in split.run_split(runs).collect()}
    for label in (0, 1):
        ordered = sorted((f"run-{label}-{i}" for i in range(n)), key=lambda v: hashlib.sha256(v.encode()).hexdigest())
        train_end = max(1, math.floor(n * 0.6))
        end = min(max(train_end + 1, math.floor(n * 0.8)), n - 1)
        expected = ["train"] * train_end + ["validation"] * (end - train_end) + ["test"] * (n - end)
        assert [found[v] for v in ordered] == expected


def test_run_split_refuses_few_runs_and_other_labels(spark):
    few = spark.createDataFrame([(f"r{i}", 0) for i in range(4)], "run_id string, label int")
    with pytest.raises(Exception, match="at least 5 runs"):
        split.run_split(few).collect()
    odd = spark.createDataFrame([(f"r{i}", 3) for i in range(9)], "run_id string, label int")
    with pytest.raises(Exception, match="unexpected label"):
        split.run_split(odd).collect()


@pytest.mark.parametrize("ready, mode", [(5, "calibration"), (4, "training")])
def test_training_mode(spark, ready, mode):
    rows = [(0, "calibration")] * 6 + [(1, "calibration")] * ready + [(1, "training")] * 9
    runs = spark.createDataFrame(rows, "label int, lab_mode string")
    assert split.training_mode(runs).first().training_mode == mode


def test_experiment_check_lists_missing_labels(spark):
    counts = spark.createDataFrame([("train", 0, 9), ("train", 1, 2)], "split string, label int, windows bigint")
    found = {(r.split, r.label): (r.windows, r.enough) for r in split.experiment_check({"train": "a", "test": "b"}, counts).collect()}
    assert found == {("train", 0): (9, True), ("train", 1): (2, False), ("test", 0): (0, False), ("test", 1): (0, False)}
    with pytest.raises(ValueError, match="different experiments"):
        split.experiment_check({"train": "a", "test": "a"}, counts)


def test_save_split_refuses_an_empty_part(spark, keyed, tmp_path):
    saved = split.save_split(split.keyed_split(keyed), str(tmp_path / "parts"))
    assert saved.count() == 1001
    only = split.keyed_split(keyed).where(F.col("split") == "train")
    with pytest.raises(ValueError, match="validation, test"):
        split.save_split(only, str(tmp_path / "short"))


def test_group_rank_equals_row_number_on_a_hot_group(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 2500, "hot").when(F.col("id") < 2990, "warm").alias("g"), F.xxhash64("id").alias("h")
    )
    ranked = ranks.group_rank(df, ["g"], [F.col("h")], ranks.long_slot(F.col("h"), 8), total="n")
    rows = ranked.collect()
    assert len(rows) == 3000
    for group in ("hot", "warm", None):
        members = sorted((r.h, r.rank) for r in rows if r.g == group)
        assert [rank for _, rank in members] == list(range(1, len(members) + 1))
        assert {r.n for r in rows if r.g == group} == {len(members)}


def test_group_rank_shuffles_its_rows_once(spark, plan_of):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select("id", (F.col("id") % 2).alias("g"), F.xxhash64("id").alias("h"))
        plan = plan_of(ranks.group_rank(df, ["g"], [F.col("h")], ranks.long_slot(F.col("h"))))
        # the window and the join share one shuffle of the rows; the other is of the slot sizes
        assert plan.count("Exchange hashpartitioning(_key_of_slot") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [10, 1500, 5000])
def test_hash_sample_takes_the_first_by_hash(spark, n):
    df = spark.range(4000).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    found = sample.hash_sample(df, "label", row_hash(["id"]), [F.col("id")], n).collect()
    everything = df.withColumn("h", row_hash(["id"])).collect()
    for label in (0, 1):
        first = sorted((r.h, r.id) for r in everything if r.label == label)[:n]
        assert sorted(r.id for r in found if r.label == label) == sorted(i for _, i in first)


def test_hash_sample_cuts_through_copies(spark):
    """A third of the rows are copies of one row; the sample still has exactly n rows."""
    df = spark.range(6000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("id"), F.lit(1).alias("label"))
    key = F.when(F.col("id") == -1, F.lit(0)).otherwise(row_hash(["id"]))
    below = df.where(key < 0).count()
    found = sample.hash_sample(df, "label", key, [F.col("id")], below + 1200)
    assert found.count() == below + 1200
    assert found.where("id = -1").count() == 1200


def test_hash_sample_of_one_key_with_many_different_rows(spark):
    """A third of the rows share an identifier but differ; the cut falls among them."""
    df = spark.range(6000).select(
        F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("id"), F.lit(1).alias("label"), F.col("id").alias("other")
    )
    key = F.when(F.col("id") == -1, F.lit(0)).otherwise(F.xxhash64("id"))
    below = df.where(key < 0).count()
    found = sample.hash_sample(df, "label", key, [F.col("id")], below + 1200)
    assert found.distinct().count() == below + 1200
    hashes = sorted((r.h, r.other) for r in df.where("id = -1").withColumn("h", row_hash(["id", "label", "other"])).collect())
    assert sorted(r.other for r in found.where("id = -1").collect()) == sorted(other for _, other in hashes[:1200])


def test_large_sample_does_not_shuffle_the_rows(spark, plan_of):
    df = spark.range(100_000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    plan = plan_of(sample.hash_sample(df, "label", row_hash(["id"]), [F.col("id")], 20_000))
    # the rows meet the written cuts by broadcast; only rows of the cut range are shuffled
    assert plan.count("BroadcastHashJoin") >= 2 and plan.count("Exchange hashpartitioning(label") <= 2


def test_small_samples_are_cut_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("label"))
    plan = plan_of(sample.first_per_group(df, "label", [F.col("id")], 5))
    assert "WindowGroupLimit" in plan
    assert sample.first_per_group(df, "label", [F.col("id")], 1001).count() == sum(
        min(row["count"], 1001) for row in df.groupBy("label").count().collect()
    )


def test_seeded_sample_is_balanced_and_repeatable(spark):
    df = spark.range(1, 21).select("id", (F.col("id") % 2).cast("int").alias("label"))
    options = dict(identifier="id", label="label", limit=10, seed=42)
    first = sorted(map(tuple, sample.seeded_sample(df, **options).collect()))
    assert [label for _, label in first].count(0) == [label for _, label in first].count(1) == 5
    assert sorted(map(tuple, sample.seeded_sample(df.repartition(6), **options).collect())) == first
    with pytest.raises(ValueError):
        sample.seeded_sample(df, identifier="id", label="label", limit=1, seed=1)
    with pytest.raises(ValueError, match="nothing"):
        sample.seeded_sample(df.where("id < 0"), **options)


def test_balanced_sample(spark):
    df = spark.range(50).select("id", (F.col("id") % 2).cast("int").alias("label"))
    found = sample.balanced_sample(df, identifier="id", label="label", per_label=4)
    assert [r["count"] for r in found.groupBy("label").count().collect()] == [4, 4]
