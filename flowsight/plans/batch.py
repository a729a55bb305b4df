"""Batch jobs from files to splits, profiles and alert reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.contract import FLOW, RAW_FLOW, Contract, RawLayout
from flowsight.operators import alerts, canonical, clean, evaluate, features, profile, quality, sample, split
from flowsight.session import written
from flowsight.sources import manifest, readers, sinks


@dataclass(frozen=True)
class Stored:
    """A table that was written and read back, with the reports made on the way."""

    rows: DataFrame
    reports: Mapping[str, DataFrame]


def bronze_job(
    spark: SparkSession, source: str, target: str, *, expected_rows: int, contract: Contract = FLOW,
    expected_files: DataFrame | None = None, sample_path: str | None = None, sample_rows: int = 100,
) -> Stored:
    """Strict CSV to checked Parquet with a validation report, and a small balanced sample.

    ``expected_files`` (``name, bytes, md5``) are the files of ``source``, a folder or a file; nothing is
    read as rows, and nothing published, before their digests are right.
    """
    reports: dict[str, DataFrame] = {}
    if expected_files is not None:
        reports["files"] = written(manifest.audit_manifest(manifest.file_manifest(spark, source), expected_files), "file-audit")
        manifest.require_verified(reports["files"])
    raw = readers.read_csv_strict(spark, source, contract.schema)
    # a bad source must not replace the last good table
    quality.require_valid(quality.validation_report(raw, contract, expected_rows=expected_rows))
    rows = sinks.write_checked(raw, target, once=False, expected_rows=expected_rows, values=True)
    report = quality.validation_report(rows, contract, expected_rows=expected_rows)
    if sample_path:
        picked = sample.balanced_sample(rows, identifier=contract.identifier, label=contract.label, per_label=sample_rows)
        sinks.write_csv_report(picked.orderBy(contract.label, contract.identifier), sample_path)
    labels = quality.value_counts(rows, contract.label)
    categories = quality.value_counts(rows, contract.category)
    return Stored(rows, {**reports, "validation": report, "labels": labels, "categories": categories})


def silver_job(spark: SparkSession, source: str, target: str, *, contract: Contract = FLOW) -> Stored:
    """Cleaned Parquet; the audit of the result must be clean."""
    bronze = contract.project(spark.read.parquet(source))
    before = written(quality.cleaning_audit(bronze, contract), "audit-before")
    kept = before.where(F.col("check_name") == "kept_rows").first()["rows"]
    rows = sinks.write_checked(clean.clean_rows(bronze, contract), target, once=False, expected_rows=kept)
    after = written(quality.cleaning_audit(rows, contract), "audit-after")
    quality.require_clean(after)
    return Stored(rows, {"before": before, "after": after})


def profile_job(rows: DataFrame, *, contract: Contract = FLOW, top: int = 15, correlations: int = 12) -> dict[str, DataFrame]:
    """The profile reports of the flow table."""
    averages = {
        "avg_source_bytes": "sbytes",
        "avg_destination_bytes": "dbytes",
        "avg_rate": "rate",
        "avg_source_packets": "spkts",
        "avg_destination_packets": "dpkts",
        "avg_duration": "dur",
    }
    rates = {f"rate_by_{name}": profile.positive_rate(rows, name, top, contract.label) for name in contract.categorical}
    medians = {"median_duration": "dur"}
    numbers = profile.numeric_profile(rows, averages=averages, medians=medians, label=contract.label, digits_of={"avg_duration": 6})
    return {
        "class_share": profile.class_share(rows, contract.label),
        "category_share": profile.category_share(rows, contract.category, top),
        **rates,
        "numeric_profile": numbers,
        "correlations": profile.label_correlations(rows, contract.numeric, correlations, contract.label),
        "imbalance": profile.imbalance(rows, contract.label),
    }


def split_job(rows: DataFrame, target: str, *, contract: Contract = FLOW, fraction: float = 0.2, seed: int = 42) -> Stored:
    """Saved train and validation rows, checked, with the size of the fitted feature vector."""
    part = split.holdout_part(contract.identifier, fraction=fraction, seed=seed)
    saved = split.save_split(rows.withColumn("split", part), target, parts=("train", "validation"))
    check = split.split_check(saved, contract.identifier, total_rows=rows.count())
    row = check.first()
    if row.shared_keys or not row.complete:
        raise ValueError(f"split of {row.keys} keys: {row.shared_keys} shared, complete: {row.complete}")
    model = features.fit_contract_model(saved.where(F.col("split") == "train"), contract)
    size = rows.sparkSession.range(1).select(F.lit(model.stages[-1].numFeatures).alias("features"))
    return Stored(saved, {"check": check, "counts": split.split_counts(saved, contract.label), "features": size})


def prepare_job(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    target: str,
    *,
    contract: Contract = FLOW,
    layout: RawLayout = RAW_FLOW,
    expected_files: DataFrame | None = None,
    verified_rows: int | None = None,
    published_rows: int | None = None,
    seed: int = 42,
) -> Stored:
    """Raw text files to canonical rows, conflict-free clean rows, and a keyed three-way split.

    Each stage is written once below ``target`` and the next reads it from there, so a lost
    executor costs its tasks and not the lineage.
    """
    reports: dict[str, DataFrame] = {}
    if expected_files is not None:
        reports["files"] = manifest.audit_manifest(manifest.file_manifest(spark, root), expected_files)
        manifest.require_verified(reports["files"])
    raw = readers.read_raw_files(spark, root, names, layout)
    bronze = sinks.write_checked(canonical.canonical_rows(raw, contract=contract, layout=layout), f"{target}/bronze")
    reports["keys"] = quality.key_audit(bronze)
    reports["tokens"] = quality.token_audit(bronze, layout)
    reports["sources"] = quality.source_counts(bronze)
    if verified_rows is not None:
        published = published_rows or verified_rows
        reports["counts"] = quality.require_count(bronze, verified_rows=verified_rows, published_rows=published)
    broken = reports["sources"].agg(F.sum("invalid_label_rows")).first()[0]
    if broken:
        raise ValueError(f"{broken} rows without a 0/1 label")
    sound = clean.without_conflicts(bronze, "flow_fingerprint")
    cleaned = clean.clean_rows(sound, contract, carry=["flow_fingerprint", "source_file"], unique=True)
    silver = sinks.write_checked(cleaned, f"{target}/silver")
    reports["keys_after"] = quality.key_audit(silver)
    if reports["keys_after"].first().conflicting_keys:
        raise ValueError("keys with contradictory labels remain")
    # every key has one label now, so the bucket alone decides the part
    parts = silver.withColumn("split", split.keyed_part("flow_fingerprint", seed=seed))
    saved = split.save_split(parts, f"{target}/split")
    reports["parts"] = split.split_counts(saved)
    return Stored(saved, reports)


def alert_job(
    scored: DataFrame, target: str, columns: Sequence[str], *, groups: Sequence[str] = (), limit: int = 200, errors: int = 50
) -> dict[str, DataFrame]:
    """The bounded alert tables as Parquet below ``target``, and the confusion measures."""
    tables = alerts.alert_export(scored, columns, alerts=limit, errors=errors, groups=groups)
    tables = {**tables, "measures": evaluate.with_ratios(evaluate.confusion(scored))}
    for name, df in tables.items():
        sinks.write_parquet(df, f"{target}/{name}", once=False)
    return {name: scored.sparkSession.read.parquet(f"{target}/{name}") for name in tables}
