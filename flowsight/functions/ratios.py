"""Ratios of the confusion matrix; a ratio over nothing is 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def with_ratios(df: DataFrame) -> DataFrame:
    """Add the derived measures to columns ``tp``, ``fp``, ``tn`` and ``fn``."""
    tp, fp, tn, fn = (F.col(name) for name in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn
    return (
        df.withColumn("total", total)
        .withColumn("precision", safe_ratio(tp, tp + fp))
        .withColumn("recall", safe_ratio(tp, tp + fn))
        .withColumn("f1", safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumn("accuracy", safe_ratio(tp + tn, total))
        .withColumn("false_positive_rate", safe_ratio(fp, fp + tn))
        .withColumn("specificity", safe_ratio(tn, tn + fp))
        .withColumn("false_negative_rate", safe_ratio(fn, fn + tp))
        .withColumn("predicted_positive_rate", safe_ratio(tp + fp, total))
    )
