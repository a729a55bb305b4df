"""Splits that depend on keys only: repeatable, disjoint and complete."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.functions.hashing import hash_bucket
from flowsight.operators.clean import single_label_rows
from flowsight.operators.ranks import group_rank, hex_slot
from flowsight.sources.sinks import write_checked

Bucket = Callable[..., Column]
PARTS = ("train", "validation", "test")


def holdout_part(key: str, *, fraction: float, seed: int, buckets: int = 10_000, bucket: Bucket = hash_bucket) -> Column:
    """``validation`` for about ``fraction`` of the keys, ``train`` for the others."""
    if not 0.0 < fraction < 1.0:
        raise ValueError("fraction must lie strictly between 0 and 1")
    if buckets < 100:
        raise ValueError("at least 100 buckets are needed")
    held = bucket(key, seed=seed, buckets=buckets) < round(fraction * buckets)
    return F.when(held, "validation").otherwise("train")


def holdout_split(df: DataFrame, key: str = "id", **options) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows; options as for ``holdout_part``."""
    validation = holdout_part(key, **options) == "validation"
    return df.where(~validation), df.where(validation)


def keyed_part(key: str, *, seed: int = 42, bucket: Bucket = hash_bucket) -> Column:
    """70 % train, 15 % validation, 15 % test by the key's bucket."""
    slot = bucket(key, seed=seed, buckets=100)
    return F.when(slot < 70, "train").when(slot < 85, "validation").otherwise("test")


def keyed_split(
    df: DataFrame, key: str = "flow_fingerprint", label: str = "label", *, seed: int = 42, bucket: Bucket = hash_bucket
) -> DataFrame:
    """Add ``split``: copies of a key stay together, keys without exactly one label are left out."""
    return single_label_rows(df, key, label).withColumn("split", keyed_part(key, seed=seed, bucket=bucket))


def split_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))


def save_split(df: DataFrame, path: str, *, parts: Sequence[str] = PARTS) -> DataFrame:
    """Write once, partitioned by ``split``, check the copy, and refuse an empty part."""
    saved = write_checked(df, path, partition_by=["split"])
    found = {row.split for row in saved.select("split").distinct().collect()}
    empty = [part for part in parts if part not in found]
    if empty:
        raise ValueError(f"empty split: {', '.join(empty)}")
    return saved


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``shared``: number of distinct keys that occur on both sides."""
    return left.select(key).intersect(right.select(key)).agg(F.count(F.lit(1)).alias("shared"))


def split_check(df: DataFrame, key: str, *, total_rows: int | None = None) -> DataFrame:
    """``keys, shared_keys, rows, complete``: no key in two parts, and no row lost."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min("split").alias("first_part"), F.max("split").alias("last_part")
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("first_part") != F.col("last_part")).alias("shared_keys"),
        rows.alias("rows"),
        (F.lit(True) if total_rows is None else rows == total_rows).alias("complete"),
    )


def require_disjoint(train: DataFrame, validation: DataFrame, key: str) -> None:
    shared = shared_keys(train, validation, key).first().shared
    if shared:
        raise ValueError(f"{shared} keys are in both parts")


def run_split(runs: DataFrame, run: str = "run_id", label: str = "label", *, least: int = 5) -> DataFrame:
    """Add ``split``: 60/20/20 of the runs of each label, in the order of the hashed run id."""
    digest = F.sha2(F.col(run), 256)
    ranked = group_rank(
        runs.withColumn("_digest", digest), [label], [F.col("_digest"), F.col(run)], hex_slot(F.col("_digest")),
        rank="_rank", total="_runs",
    )
    n, place = F.col("_runs"), F.col("_rank")
    train_end = F.greatest(F.lit(1), F.floor(n * 0.60))
    validation_end = F.least(F.greatest(train_end + 1, F.floor(n * 0.80)), n - 1)
    part = F.when(place <= train_end, "train").when(place <= validation_end, "validation").otherwise("test")
    known = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    checked = F.when(~known, F.raise_error(F.lit("unexpected label of a run"))).when(
        n < least, F.raise_error(F.lit(f"at least {least} runs per label are needed"))
    ).otherwise(part)
    return ranked.withColumn("split", checked).drop("_digest", "_rank", "_runs")


def training_mode(runs: DataFrame, label: str = "label", mode: str = "lab_mode", *, least: int = 5) -> DataFrame:
    """``training_mode``: calibration if it has enough runs of both labels, else training."""
    ready = [
        F.count_if((F.col(mode) == "calibration") & (F.col(label) == value)) >= least for value in (0, 1)
    ]
    return runs.agg(F.when(ready[0] & ready[1], "calibration").otherwise("training").alias("training_mode"))


def experiment_check(frames: Mapping[str, str], counts: DataFrame, *, least: int = 5) -> DataFrame:
    """``split, label, windows, enough`` for experiments that must all be different.

    ``counts(split, label, windows)`` are the labelled windows found for each part.
    """
    if len(set(frames.values())) != len(frames):
        raise ValueError("the parts must come from different experiments")
    cells = F.array(*[F.struct(F.lit(p).alias("split"), F.lit(v).alias("label")) for p in frames for v in (0, 1)])
    wanted = counts.sparkSession.range(1).select(F.inline(cells))
    windows = F.coalesce("windows", F.lit(0))
    return wanted.join(counts, ["split", "label"], "left").select(
        "split", "label", windows.alias("windows"), (windows >= least).alias("enough")
    )
