"""Confusion counts, threshold curves, threshold choice and ranking measures."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsight.contract import require_columns
from flowsight.functions.predicates import rows_where
from flowsight.functions.ratios import with_ratios
from flowsight.operators.ranges import KEY, RANGE, ROWS, adaptive_ranges
from flowsight.session import written

# The thresholds tried by default, and the shorter list for sessions and windows.
THRESHOLDS = (0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90)
WINDOW_THRESHOLDS = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def positive_score(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``tp, fp, tn, fn``."""
    require_columns(df, [label, prediction])
    truth, guess = F.col(label), F.col(prediction)
    return df.agg(
        rows_where((truth == 1) & (guess == 1)).alias("tp"),
        rows_where((truth == 0) & (guess == 1)).alias("fp"),
        rows_where((truth == 0) & (guess == 0)).alias("tn"),
        rows_where((truth == 1) & (guess == 0)).alias("fn"),
    )


def grid_of(thresholds: Iterable[float]) -> list[float]:
    grid = sorted({float(t) for t in thresholds})
    if not grid or not all(math.isfinite(t) and 0.0 < t < 1.0 for t in grid):
        raise ValueError("thresholds must be finite and lie strictly between 0 and 1")
    return grid


def steps_reached(score: Column, grid: Sequence[float], start: int = 0) -> Column:
    """How many thresholds of the sorted grid the score reaches, by bisection."""
    if not grid:
        return F.lit(start)
    middle = len(grid) // 2
    below = steps_reached(score, grid[:middle], start)
    above = steps_reached(score, grid[middle + 1 :], start + middle + 1)
    return F.when(score < grid[middle], below).otherwise(above)


def threshold_counts(df: DataFrame, thresholds: Iterable[float], *, score: Column, label: str = "label") -> DataFrame:
    """``threshold, tp, fp, tn, fn`` when rows with score >= threshold are called positive.

    Rows are counted once per step of the grid and then summed up from the top, so the work does
    not grow with the number of thresholds. Rows without a label or score count nowhere.
    """
    grid = grid_of(thresholds)
    scored = df.select(F.col(label).cast("int").alias("_label"), score.cast("double").alias("_score"))
    counted = (
        scored.where(F.col("_label").isin(0, 1) & F.col("_score").isNotNull())
        .groupBy(steps_reached(F.col("_score"), grid).alias("step"))
        .agg(F.count_if(F.col("_label") == 1).alias("ones"), F.count_if(F.col("_label") == 0).alias("zeros"))
    )
    # one row per step, also for steps that no row reaches
    steps = df.sparkSession.range(1).select(
        F.posexplode(F.array(F.lit(None).cast("double"), *[F.lit(t) for t in grid])).alias("step", "threshold")
    )
    all_steps = Window.partitionBy(F.lit(0))
    from_here = all_steps.orderBy(F.desc("step"))
    ones, zeros = F.coalesce("ones", F.lit(0)), F.coalesce("zeros", F.lit(0))
    summed = steps.join(counted, "step", "left").select(
        "threshold",
        F.sum(ones).over(from_here).alias("tp"),
        F.sum(zeros).over(from_here).alias("fp"),
        F.sum(ones).over(all_steps).alias("all_ones"),
        F.sum(zeros).over(all_steps).alias("all_zeros"),
    )
    counts = summed.where(F.col("threshold").isNotNull()).select(
        "threshold", "tp", "fp", (F.col("all_zeros") - F.col("fp")).alias("tn"), (F.col("all_ones") - F.col("tp")).alias("fn")
    )
    return counts.sortWithinPartitions("threshold")  # the steps are in one partition already


def threshold_curve(
    df: DataFrame,
    thresholds: Iterable[float] = THRESHOLDS,
    *,
    label: str = "label",
    probability: str = "probability",
    score: str | None = None,
) -> DataFrame:
    """The counts and every derived measure per threshold."""
    value = F.col(score) if score else positive_score(probability)
    return with_ratios(threshold_counts(df, thresholds, score=value, label=label))


def best_threshold(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: highest metric, then recall, lower false positive rate, nearest to 0.5, lowest."""
    require_columns(curve, [metric])
    return curve.orderBy(
        F.desc(metric), F.desc("recall"), F.asc("false_positive_rate"), F.abs(F.col("threshold") - 0.5), "threshold"
    ).limit(1)


def most_sensitive_threshold(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: as above, but among equally good thresholds the lowest."""
    require_columns(curve, [metric])
    return curve.orderBy(F.desc(metric), F.desc("recall"), F.asc("false_positive_rate"), "threshold").limit(1)


def measure_at(df: DataFrame, threshold: float, **options) -> DataFrame:
    return threshold_curve(df, [threshold], **options)


def score_steps(df: DataFrame, label: str, raw: str) -> DataFrame:
    """``score, ones, zeros``: the rows of each distinct score; rows without a label or score count nowhere."""
    value = positive_score(raw) if isinstance(df.schema[raw].dataType, VectorUDT) else F.col(raw).cast("double")
    scored = df.select(F.col(label).cast("int").alias("_label"), value.alias("score"))
    known = scored.where(F.col("_label").isin(0, 1) & F.col("score").isNotNull())
    return known.groupBy("score").agg(F.sum("_label").alias("ones"), F.sum(1 - F.col("_label")).alias("zeros"))


def ranking_measures(
    df: DataFrame, *, label: str = "label", raw: str = "rawPrediction", rows: int = ROWS, slots: int | None = None
) -> DataFrame:
    """One row: ``roc_auc, pr_auc``, the exact areas under both curves by trapezoids over all distinct scores.

    The precision curve begins at the precision of the highest score. Both are NULL without rows of
    both labels. Distinct scores are counted first and written; they are then summed up from the top
    inside ranges of at most ``rows`` scores, so no task orders more of them; ``slots`` asks for at least so many
    ranges, as far as there are scores.
    """
    steps = written(score_steps(df, label, raw), "score-steps")
    if slots is not None:
        rows = max(1, min(rows, steps.count() // slots))
    ranged, _ = adaptive_ranges(steps.withColumn(KEY, F.struct("score")), rows=rows)
    slotted = ranged.select("score", "ones", "zeros", F.col(RANGE).alias("slot"))
    all_slots = Window.partitionBy(F.lit(0))
    above = all_slots.orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sums = slotted.groupBy(F.col("slot").alias("_slot")).agg(F.sum("ones").alias("ones_in"), F.sum("zeros").alias("zeros_in"))
    sums = sums.select(
        "_slot",
        F.coalesce(F.sum("ones_in").over(above), F.lit(0)).alias("ones_above"),
        F.coalesce(F.sum("zeros_in").over(above), F.lit(0)).alias("zeros_above"),
        F.sum("ones_in").over(all_slots).alias("all_ones"),
        F.sum("zeros_in").over(all_slots).alias("all_zeros"),
    )
    inside = Window.partitionBy("slot").orderBy(F.desc("score"))
    points = slotted.join(sums, F.col("slot") == F.col("_slot")).select(
        "ones", "zeros", "all_ones", "all_zeros",
        (F.col("ones_above") + F.sum("ones").over(inside)).alias("tp"),
        (F.col("zeros_above") + F.sum("zeros").over(inside)).alias("fp"),
    )
    ones, zeros, tp, fp = (F.col(name) for name in ("ones", "zeros", "tp", "fp"))
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - ones, tp + fp - ones - zeros), precision)
    roc = F.try_divide(F.sum(zeros * (2 * tp - ones) / 2), F.max("all_ones") * F.max("all_zeros").cast("double"))
    pr = F.try_divide(F.sum(ones * (precision + before) / 2), F.max("all_ones"))
    return points.agg(roc.alias("roc_auc"), F.when(F.max("all_zeros") > 0, pr).alias("pr_auc"))


def challenge_measures(
    df: DataFrame, threshold: float, *, mode: str = "training", mode_column: str = "lab_mode", **options
) -> DataFrame:
    """Measures on the runs of a mode that was not trained on; empty if there are none."""
    measured = measure_at(df.where(F.col(mode_column) == mode).drop(mode_column), threshold, **options)
    return measured.where(F.col("total") > 0).select(F.lit(mode).alias("source_mode"), "*")
