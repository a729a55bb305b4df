"""Scored windows against the truth that arrives apart from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.functions.predicates import outcome
from flowsight.operators.ranges import KEY, RANGE, ROWS, adaptive_ranges, total_order
from flowsight.operators.ranks import group_rank
from flowsight.operators.windows import WINDOW_SECONDS, event_time


def truth_windows(truth: DataFrame, *, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``source_ip, window_start, truth_count, actual``: a window is positive if any event is."""
    events = truth.withColumn("event_time", event_time(truth))
    usable = events.where(F.col("event_time").isNotNull() & F.col("source_ip").isNotNull())
    grouped = usable.groupBy("source_ip", F.window("event_time", f"{seconds} seconds").alias("span"))
    counted = grouped.agg(F.count(F.lit(1)).alias("truth_count"), F.max("label").cast("int").alias("highest"))
    actual = F.greatest(F.coalesce("highest", F.lit(0)), F.lit(0))
    return counted.select("source_ip", F.col("span.start").alias("window_start"), "truth_count", actual.alias("actual"))


def reconcile(
    scored: DataFrame,
    truth: DataFrame,
    *,
    watermark: datetime | Column | None = None,
    run_complete: bool = False,
    seconds: int = WINDOW_SECONDS,
) -> DataFrame:
    """Add ``checked, outcome, actual`` to scored windows.

    A window is final once the run is complete or the watermark has reached its end; it is then
    checked if the truth has as many events as the window.
    """
    final = F.lit(run_complete)
    if watermark is not None:
        final = final | (F.col("window_end") <= watermark)
    whole = F.coalesce(F.col("truth_count") == F.col("flow_count").cast("bigint"), F.lit(False))
    told = scored.join(truth_windows(truth, seconds=seconds), ["source_ip", "window_start"], "left").withColumn(
        "checked", final & whole
    )
    verdict = F.when(~final, "provisional").when(~whole, "awaiting_truth").otherwise(outcome("actual"))
    return told.select(
        *scored.columns, "checked", verdict.alias("outcome"), F.when(F.col("checked"), F.col("actual")).alias("actual")
    )


def outcome_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("outcome").agg(F.count(F.lit(1)).alias("windows"))


def windows_per_source(windows: DataFrame, source: str = "actor_id") -> DataFrame:
    return windows.groupBy(source).agg(F.count(F.lit(1)).alias("windows"))


def latest_windows(windows: DataFrame, source: str = "actor_id") -> DataFrame:
    """The newest window of each named source."""
    rest = [name for name in windows.columns if name not in (source, "window_start")]
    newest = F.max(F.struct("window_start", *rest)).alias("newest")
    return windows.where(F.col(source).isNotNull()).groupBy(source).agg(newest).select(source, "newest.*")


def numbered_windows(windows: DataFrame, source: str = "actor_id", *, rows: int = ROWS) -> DataFrame:
    """Add ``window_number``: place of a window in its source's series.

    A series is cut into ranges of its order, so that no task orders more rows of it than
    ``rows``, however many of them fall on one day. ``windows`` should be a written table.
    """
    keyed = windows.withColumn(KEY, total_order(windows, ["window_start"]))
    ranged, _ = adaptive_ranges(keyed, [source], rows=rows)
    numbered = group_rank(ranged, [source], [F.col(KEY)], F.col(RANGE), rank="window_number")
    return numbered.select(*windows.columns, "window_number")


def latest_per_key(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the highest version of each key; a key has at most one row of each version.

    The versions alone are aggregated, in a hash table, and the rows joined back to them: a greatest
    struct with texts in it would sort all rows twice.
    """
    newest = df.groupBy(*keys).agg(F.max(version).alias("_newest"))
    same = [df[key].eqNullSafe(newest[key]) for key in keys]
    on = (df[version] == newest["_newest"])
    for condition in same:
        on = on & condition
    return df.join(newest, on, "left_semi")
