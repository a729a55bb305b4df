import hashlib

import pytest
from pyspark.sql import functions as F

from flowsight.contract import FLOW, RAW_FLOW, ddl
from flowsight.operators import checks, profile
from flowsight.session import scratch_path, written
from flowsight.sources import manifest, readers, sinks


def test_strict_csv(spark, tmp_path):
    schema = ddl("id int, label int")
    (tmp_path / "good.csv").write_text("id,label\n1,0\n2,1\n")
    (tmp_path / "swapped.csv").write_text("label,id\n1,0\n")
    (tmp_path / "wrong.csv").write_text("id,label\n1,maybe\n")
    assert readers.read_csv_strict(spark, str(tmp_path / "good.csv"), schema).collect() == [(1, 0), (2, 1)]
    with pytest.raises(ValueError, match="unexpected header"):
        readers.read_csv_strict(spark, str(tmp_path / "swapped.csv"), schema)
    with pytest.raises(Exception):
        readers.read_csv_strict(spark, str(tmp_path / "wrong.csv"), schema).collect()


def test_raw_files(spark, tmp_path):
    names = [f"part_{i}.csv" for i in range(4)]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(",".join([f"0x{i}"] * len(RAW_FLOW.columns)) + "\n")
    raw = readers.read_raw_files(spark, str(tmp_path), names, RAW_FLOW)
    assert {f.dataType.typeName() for f in raw.schema.fields} == {"string"}
    assert sorted(r.source_file for r in raw.collect()) == names
    with pytest.raises(FileNotFoundError, match="part_9.csv"):
        readers.read_raw_files(spark, str(tmp_path), [*names, "part_9.csv"], RAW_FLOW)


def test_events_of_several_folders(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.jsonl").write_text('{"event_id": "%s", "sbytes": 5}\n' % name)
    events = readers.read_events(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert sorted((r.event_id, r.sbytes, r.dur) for r in events.collect()) == [("one", 5, None), ("two", 5, None)]
    (tmp_path / "runs.json").write_text('{"run_id": "r", "label": 1, "lab_mode": "training", "expected_flows": 3}\n')
    assert readers.read_run_truth(spark, str(tmp_path / "runs.json")).first().expected_flows == 3


def test_union_and_nested_parquet(spark, tmp_path):
    a, b = spark.range(3).withColumn("x", F.lit(1)), spark.range(3).select(F.lit(2).alias("x"), "id")
    assert readers.union_all([a, b]).where("x = 2").count() == 3
    a.write.parquet(str(tmp_path / "t" / "deep" / "a"))
    b.write.parquet(str(tmp_path / "t" / "deep" / "b"))
    assert readers.read_parquet(spark, str(tmp_path / "t"), nested=True).count() == 6


def test_write_checked(spark, tmp_path):
    df = spark.range(100).withColumn("half", F.col("id") / 2).withColumn("side", (F.col("id") % 2).cast("string"))
    back = sinks.write_checked(df, str(tmp_path / "t"), partition_by=["side"])
    assert back.columns == df.columns or set(back.columns) == set(df.columns)
    assert back.count() == 100
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_checked(df, str(tmp_path / "t"))
    assert sinks.write_checked(df.limit(7), str(tmp_path / "t2"), once=False).count() == 7
    assert sinks.write_checked(df.where("id < 0"), str(tmp_path / "t3")).count() == 0


def test_write_checked_runs_the_plan_once_and_notices_values(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(50).withColumn("text", F.when(F.col("id") % 3 == 0, "t"))
    back = sinks.write_checked(rows.mapInArrow(count, rows.schema), str(tmp_path / "once"), expected_rows=50, values=True)
    assert seen.value == 50 and back.count() == 50
    with pytest.raises(ValueError, match="50 rows, 49 expected"):
        sinks.write_checked(rows, str(tmp_path / "fewer"), expected_rows=49, values=True)

    def wrong(df, path, **options):
        df.withColumn("text", F.coalesce("text", F.when(F.col("id") == 4, "u"))).write.parquet(path)

    monkeypatch.setattr(sinks, "write_parquet", wrong)
    with pytest.raises(ValueError, match="other values"):
        sinks.write_checked(rows, str(tmp_path / "changed"), values=True)
    monkeypatch.setattr(sinks, "write_parquet", lambda df, path, **options: df.where("id <> 7").write.parquet(path))
    with pytest.raises(ValueError, match="reads back 49"):
        sinks.write_checked(rows, str(tmp_path / "less"), values=True)


def test_a_session_that_has_observed_cannot_use_a_fitted_regression(spark, tmp_path):
    """Why the checked write does not observe: in a session of its own, as the session is of no use afterwards."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import Observation

    own = spark.newSession()
    rows = own.createDataFrame([(float(i % 2), Vectors.dense(i % 7, 1.0)) for i in range(40)], ["label", "features"])
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(str(tmp_path / "seen"))
    assert seen.get == {"rows": 40}
    model = LogisticRegression(maxIter=2).fit(rows)
    with pytest.raises(Exception, match="(?s)ObservationManager"):
        model.transform(rows).write.parquet(str(tmp_path / "scored"))


def test_written_tables_live_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{base}/x-")
    table = written(spark.range(9), "nine")
    assert all(path.removeprefix("file://").removeprefix("file:").startswith(base) for path in table.inputFiles())


def test_manifest(spark, tmp_path):
    files = {"a.csv": b"one", "b.csv": b"", "c.csv": b"three", "sub/d.csv": b"four"}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = manifest.file_manifest(spark, str(tmp_path))
    rows = {r.name: r for r in found.collect()}
    assert set(rows) == set(files)
    assert (rows["b.csv"].bytes, rows["b.csv"].md5) == (0, hashlib.md5().hexdigest())
    assert {tuple(row) for row in manifest.file_manifest(spark, str(tmp_path), whole_bytes=3).collect()} == {tuple(row) for row in rows.values()}
    assert [row.name for row in manifest.file_manifest(spark, str(tmp_path / "a.csv")).collect()] == ["a.csv"]
    assert rows["c.csv"].sha256 == hashlib.sha256(b"three").hexdigest() and rows["c.csv"].bytes == 5
    md5 = {name: hashlib.md5(content).hexdigest() for name, content in files.items()}
    expected = spark.createDataFrame(
        [("a.csv", 3, md5["a.csv"].upper()), ("b.csv", 0, md5["b.csv"]), ("c.csv", 5, md5["a.csv"]), ("e.csv", 1, ""), ("sub/d.csv", 9, "")],
        "name string, bytes bigint, md5 string",
    )
    audit = manifest.audit_manifest(found, expected)
    assert {r.name: r.status for r in audit.collect()} == {
        "a.csv": "verified", "b.csv": "verified", "c.csv": "digest_differs", "e.csv": "missing", "sub/d.csv": "size_differs",
    }
    with pytest.raises(ValueError, match="c.csv digest_differs, e.csv missing"):
        manifest.require_verified(audit)


def test_manifest_of_odd_names_and_a_file_of_three_gigabytes(spark, tmp_path):
    for name in ("a b.csv", "c+d.csv", "e%20f.csv", "g#h.csv"):
        (tmp_path / name).write_bytes(name.encode())
        (tmp_path / f"empty {name}").write_bytes(b"")
    with open(tmp_path / "sparse.bin", "wb") as file:
        file.truncate(3 << 30)
    rows = {r.name: r for r in manifest.file_manifest(spark, str(tmp_path)).collect()}
    assert len(rows) == 9 and sum(row.bytes == 0 for row in rows.values()) == 4
    assert all(rows[name].md5 == hashlib.md5(name.encode()).hexdigest() for name in ("a b.csv", "c+d.csv", "e%20f.csv", "g#h.csv"))
    assert rows["sparse.bin"].bytes == 3 << 30
    expected = hashlib.md5()
    for _ in range(3 << 7):
        expected.update(bytes(8 << 20))
    assert rows["sparse.bin"].md5 == expected.hexdigest()


def test_hash_tree_changes_one_branch(spark):
    def files(changed=None):
        digest = F.sha2(F.concat("name", F.when(F.col("name") == changed, "x").otherwise("y")), 256)
        return spark.range(3_000).select(F.concat(F.lit("f"), "id").alias("name")).withColumn("sha256", digest)

    before, after = manifest.hash_tree(files("none")), manifest.hash_tree(files("f17"))
    leaf = hashlib.sha256(b"f17").hexdigest()[:4]
    assert [row.prefix for row in manifest.changed_leaves(before, after).collect()] == [leaf]
    old, new = ({row.prefix: row.digest for row in tree.collect()} for tree in (before, after))
    assert {prefix for prefix in old if old[prefix] != new[prefix]} == {leaf, leaf[:2], ""}
    sizes = before.groupBy(F.length("prefix").alias("level")).agg(F.sum("files").alias("files")).collect()
    assert {row.level: row.files for row in sizes} == {4: 3_000, 2: 3_000, 0: 3_000}
    assert manifest.changed_leaves(before, manifest.hash_tree(files("none").repartition(7))).isEmpty()


def test_folder_digest_notices_changes(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a").write_text("1")
    first = manifest.folder_digest(spark, str(tmp_path / "m"))
    assert manifest.folder_digest(spark, str(tmp_path / "m")) == first
    (tmp_path / "m" / "a").write_text("2")
    assert manifest.folder_digest(spark, str(tmp_path / "m")) != first


def flows(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 3).cast("int").alias("label"), F.concat(F.lit("p"), F.col("id") % 5).alias("proto"), F.col("id").alias("sbytes")
    )


def totals(df):
    return profile.representative(df, label="label", group="proto", sums={"source_bytes": "sbytes"})


def test_results_do_not_depend_on_partitions_or_size(spark):
    report = checks.growth_invariance(flows(spark), totals, order=["sbytes"], sizes=[50], counts=[1, 2, 4])
    rows = report.collect()
    assert len(rows) == 6 and all(r.same for r in rows)
    assert {r.prefix_rows for r in rows} == {50, None}
    checks.require_same(report)


def test_held_rows_give_the_same_and_are_let_go(spark, tmp_path):
    flows(spark).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    variants = checks.read_and_kept({"parquet": table}, totals)
    found = checks.with_verdict(variants).collect()
    assert {row.variant for row in found} == {"parquet", "parquet, kept"} and all(row.same for row in found)
    assert not table.is_cached and "InMemoryTableScan" not in checks.plan_of(totals(spark.read.parquet(str(tmp_path / "t"))))
    with pytest.raises(ValueError, match="does not read the rows that are held"):
        checks.read_and_kept({"parquet": table}, lambda df: flows(spark))
    with pytest.raises(ZeroDivisionError):
        checks.read_and_kept({"parquet": table}, lambda df: 1 / 0)
    assert not table.is_cached
    variants = {"all": flows(spark), "fewer": flows(spark, 399)}
    assert {row.same for row in checks.with_verdict(variants).where("variant = 'fewer'").collect()} == {False}


def test_signatures_tell_where_null_is(spark):
    left = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    right = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    assert checks.signature(left).first().signature != checks.signature(right).first().signature
    assert checks.signature(left.limit(0)).first() == (0, "0")


def test_differing_results_are_named(spark):
    report = checks.compare_variants({"all": flows(spark), "fewer": flows(spark, 399)})
    with pytest.raises(ValueError, match="fewer"):
        checks.require_same(report)


def test_representative_aggregate_plan(spark, tmp_path, plan_of):
    df = flows(spark).withColumn("unused", F.lit("x" * 50))
    df.write.parquet(str(tmp_path / "t"))
    plan = plan_of(totals(spark.read.parquet(str(tmp_path / "t"))))
    assert "unused" not in plan and "PushedFilters: [In(label, [0,1])]" in plan and plan.count("HashAggregate") >= 2


def test_profile_reports(spark, flow_row):
    rows = [flow_row(id=1), flow_row(id=2, attack_cat="DoS", label=1, sbytes=9), flow_row(id=3, proto="udp", attack_cat="DoS", label=1, sbytes=8)]
    df = spark.createDataFrame(rows, FLOW.schema)
    share = {r.traffic_class: (r.flow_count, r.percentage) for r in profile.class_share(df).collect()}
    assert share == {"Positive": (2, 66.6667), "Negative": (1, 33.3333)}
    assert [(r.proto, r.flow_count, r.positive_count, r.positive_percentage) for r in profile.positive_rate(df, "proto", 2).collect()] == [
        ("tcp", 2, 1, 50.0), ("udp", 1, 1, 100.0),
    ]
    assert profile.category_share(df, "attack_cat", 1).first().attack_cat == "DoS"
    top = profile.label_correlations(df, FLOW.numeric, 3).collect()
    assert [r.feature for r in top] == ["sbytes"]
    assert profile.imbalance(df).first().ratio == 2.0
    summary = {(r.item, r.detail): r.rows for r in profile.table_summary(df).collect()}
    assert summary["label", "1"] == 2 and summary["column 1 id", "int"] is None


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_exact_medians(spark, n):
    df = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 5003).cast("double").alias("x"))
    values = sorted(r.x for r in df.collect())
    assert profile.exact_medians(df, "x", "g").first().median == values[(n + 1) // 2 - 1]


def test_exact_median_of_a_hot_value(spark):
    df = spark.range(9000).select(F.lit(0).alias("g"), F.when(F.col("id") < 4000, 5.0).otherwise(F.col("id") / 7).alias("x"))
    values = sorted(r.x for r in df.collect())
    assert profile.exact_medians(df, "x", "g", accuracy=100).first().median == values[4499]
