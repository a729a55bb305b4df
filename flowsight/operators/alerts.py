"""Bounded reports from scored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.functions.predicates import outcome
from flowsight.operators.sample import first_per_group
from flowsight.sources.readers import union_all

SCORE = "attack_probability"


def outcome_rows(df: DataFrame, name: str, *, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows of one confusion cell, such as ``false_positive``."""
    return df.where(outcome(label, prediction) == name)


def top_alerts(df: DataFrame, limit: int, *, identifier: str = "id", score: str = SCORE) -> DataFrame:
    return df.where(F.col("prediction") == 1).orderBy(F.desc(score), identifier).limit(limit)


def top_false_positives(df: DataFrame, limit: int, *, identifier: str = "id", score: str = SCORE) -> DataFrame:
    return outcome_rows(df, "false_positive").orderBy(F.desc(score), identifier).limit(limit)


def lowest_false_negatives(df: DataFrame, limit: int, *, identifier: str = "id", score: str = SCORE) -> DataFrame:
    return outcome_rows(df, "false_negative").orderBy(F.asc(score), identifier).limit(limit)


def alert_distribution(df: DataFrame, column: str, limit: int = 15, *, score: str = SCORE) -> DataFrame:
    """The values with most alerts, and the mean score of those alerts."""
    alerts = df.where(F.col("prediction") == 1).groupBy(column)
    counted = alerts.agg(F.count(F.lit(1)).alias("alert_count"), F.avg(score).alias("mean_score"))
    return counted.orderBy(F.desc("alert_count"), column).limit(limit)


def outcome_examples(df: DataFrame, n: int = 3, *, identifier: str = "id") -> DataFrame:
    """The first ``n`` rows of each confusion cell by identifier."""
    told = df.withColumn("outcome", outcome()).where(F.col("outcome").isNotNull())
    return first_per_group(told, "outcome", [F.col(identifier)], n)


def alert_export(
    df: DataFrame, columns: Sequence[str], *, alerts: int = 200, errors: int = 50, groups: Sequence[str] = ()
) -> Mapping[str, DataFrame]:
    """The tables of an alert report, each bounded by its limit."""
    if alerts < 1 or errors < 1:
        raise ValueError("limits must be positive")
    told = df.select(*columns)
    tables = {
        "alerts": top_alerts(told, alerts),
        "false_positives": top_false_positives(told, errors),
        "false_negatives": lowest_false_negatives(told, errors),
    }
    if groups:
        parts = []
        for column in groups:
            name, value = F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value")
            parts.append(alert_distribution(df, column).select(name, value, "alert_count", "mean_score"))
        tables["alert_distribution"] = union_all(parts)
    return tables
