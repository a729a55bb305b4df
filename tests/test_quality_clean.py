import pytest
from pyspark.sql import functions as F

from flowsight.contract import FLOW, RAW_FLOW
from flowsight.operators import canonical, clean, quality


@pytest.fixture(scope="module")
def dirty(spark, flow_row):
    first = flow_row(id=1, proto=" TCP ", service="-", state=" fin ")
    rows = [
        first,
        flow_row(id=2, service="-", dur=None, rate=-3.0, sload=float("inf"), attack_cat=" backdoors ", label=1),
        flow_row(id=3, service="-", label=2),
        first,
    ]
    return spark.createDataFrame(rows, FLOW.schema)


def audit_of(df):
    return {(r.check_name, r.column_name): r.rows for r in quality.cleaning_audit(df, FLOW).collect()}


def test_cleaning_audit_counts_each_problem(dirty):
    found = audit_of(dirty)
    assert found["all_rows", ""] == 4
    assert found["duplicate_row", ""] == 1
    assert found["broken_target", "label"] == 1
    assert [found["unusable_number", c] for c in ("dur", "rate", "sload")] == [1, 1, 1]
    assert found["missing_text", "service"] == 4
    assert found["kept_rows", ""] == 2
    assert sum(found.values()) == 4 + 2 + 1 + 1 + 3 + 4


def test_clean_rows_normalises_and_passes_its_own_audit(dirty):
    cleaned = clean.clean_rows(dirty, FLOW)
    assert cleaned.columns == FLOW.columns
    rows = {r.id: r for r in cleaned.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].proto, rows[1].service, rows[1].state, rows[1].attack_cat) == ("tcp", "__unknown__", "fin", "Normal")
    assert (rows[2].dur, rows[2].rate, rows[2].sload, rows[2].attack_cat) == (0.0, 0.0, 0.0, "Backdoor")
    quality.require_clean(quality.cleaning_audit(cleaned, FLOW))
    with pytest.raises(ValueError, match="not clean"):
        quality.require_clean(quality.cleaning_audit(dirty, FLOW))


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, False),
        ({"id": 0}, True),
        ({"label": 7}, True),
        ({"attack_cat": None}, True),
        ({"attack_cat": " - "}, True),
        ({"attack_cat": "Generic"}, True),
        ({"attack_cat": "Generic", "label": 1}, False),
        ({"attack_cat": "NORMAL ", "label": 1}, True),
        ({"attack_cat": "NORMAL "}, False),
    ],
)
def test_target_rules(spark, flow_row, change, broken):
    df = spark.createDataFrame([flow_row(**change)], FLOW.schema)
    assert audit_of(df)["broken_target", "label"] == int(broken)


def test_nan_is_unusable_and_unlisted_category_keeps_its_spelling(spark, flow_row):
    rows = [flow_row(id=5, dur=float("nan"), attack_cat=" Odd Thing ", label=1)]
    row = clean.clean_rows(spark.createDataFrame(rows, FLOW.schema), FLOW).first()
    assert (row.dur, row.attack_cat) == (0.0, "Odd Thing")


def test_carried_columns_survive_cleaning(spark, flow_row):
    df = spark.createDataFrame([flow_row(id=1), flow_row(id=1)], FLOW.schema).withColumn("source_file", F.lit("a.csv"))
    assert clean.clean_rows(df, FLOW, carry=["source_file"]).select("id", "source_file").collect() == [(1, "a.csv")]
    assert clean.clean_rows(df, FLOW, carry=["source_file"], unique=True).count() == 2


def test_key_audit_and_conflicts(spark):
    rows = [("copy", 0), ("copy", 0), ("clash", 0), ("clash", 1), ("alone", 1)]
    df = spark.createDataFrame(rows, "flow_fingerprint string, label int")
    assert quality.key_audit(df).first().asDict() == {
        "rows": 5, "unique_keys": 3, "duplicate_rows": 2, "conflicting_keys": 1, "conflicting_rows": 2,
    }
    assert {r.flow_fingerprint for r in clean.without_conflicts(df, "flow_fingerprint").collect()} == {"copy", "alone"}
    assert {r.flow_fingerprint for r in clean.only_conflicts(df, "flow_fingerprint").collect()} == {"clash"}


def test_missing_label_is_a_version_for_the_audit_only(spark):
    df = spark.createDataFrame([("k", 1), ("k", None), ("n", None)], "flow_fingerprint string, label int")
    assert quality.key_audit(df).first().conflicting_keys == 1
    assert clean.single_label_rows(df, "flow_fingerprint").count() == 2


def test_small_conflict_list_is_broadcast(spark, plan_of):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"))
    assert "BroadcastHashJoin" in plan_of(clean.without_conflicts(df, "k"))


def raw_frame(spark, *changes):
    base = {c: "1" for c in RAW_FLOW.columns}
    base |= {"srcip": "10.0.0.1", "dstip": "10.0.0.2", "proto": "TCP", "state": "FIN", "service": "-", "attack_cat": "", "label": "0"}
    rows = [tuple({**base, **change}[c] for c in RAW_FLOW.columns) for change in changes]
    return spark.createDataFrame(rows, RAW_FLOW.schema)


def test_hexadecimal_and_decimal_ports_are_the_same_flow(spark):
    raw = raw_frame(spark, {"sport": "49320", "dsport": "80"}, {"sport": " 0XC0A8", "dsport": "0x0050"})
    found = canonical.canonical_rows(raw, source_file="one.csv").select("flow_fingerprint", "source_file").distinct().collect()
    assert len(found) == 1 and len(found[0].flow_fingerprint) == 64


def test_bad_tokens_are_recorded_not_fatal(spark):
    raw = raw_frame(
        spark,
        {"ct_ftp_cmd": " ", "ct_flw_http_mthd": "not-a-number", "dur": "2.0", "Spkts": "2", "Dpkts": "3"},
        {"sport": "0x" + "f" * 30, "dsport": "0x0", "dur": "0", "attack_cat": " Worms ", "label": "1"},
    )
    rows = canonical.canonical_rows(raw, source_file="one.csv")
    assert len(rows.columns) == 49 and "srcip" not in rows.columns
    first, second = rows.orderBy("label").collect()
    assert (first.ct_ftp_cmd, first.missing_fields, first.malformed_fields) == (None, ["ct_ftp_cmd"], ["ct_flw_http_mthd"])
    assert (first.rate, first.attack_cat) == (2.5, "Normal")
    assert (second.rate, second.attack_cat, second.malformed_fields) == (0.0, "Worms", ["sport"])
    assert rows.select("id").distinct().count() == 2
    audit = {r.column_name: (r.malformed_rows, r.missing_rows) for r in quality.token_audit(rows, RAW_FLOW).collect()}
    assert (audit["sport"], audit["ct_ftp_cmd"], audit["dur"]) == ((1, 0), (0, 1), (0, 0))


def test_raw_rows_need_a_source(spark):
    with pytest.raises(ValueError, match="source_file"):
        canonical.canonical_rows(raw_frame(spark, {}))


def test_counts_and_validation(spark, flow_row):
    df = spark.createDataFrame([flow_row(id=1), flow_row(id=2, service=None)], FLOW.schema)
    report = {r.check_name: r.value for r in quality.validation_report(df, FLOW, expected_rows=2).collect()}
    assert (report["row_count"], report["column_count"], report["null_service"]) == (2, 45, 1)
    with pytest.raises(ValueError, match="row_count"):
        quality.require_valid(quality.validation_report(df, FLOW, expected_rows=3))
    assert quality.require_count(df, verified_rows=2, published_rows=5).first().difference_from_published == -3
    with pytest.raises(ValueError, match="2 rows, 3 expected"):
        quality.require_count(df, verified_rows=3, published_rows=3)
