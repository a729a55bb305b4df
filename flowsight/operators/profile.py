"""Profiles of a labelled table in Spark SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.functions.predicates import long_rows
from flowsight.operators.ranks import group_rank
from flowsight.session import written


def representative(df: DataFrame, *, label: str, group: str, sums: Mapping[str, str]) -> DataFrame:
    """Rows and exact sums per label and group, in order; ``sums`` maps output names to columns.

    Groups are few, such as states: their partial sums, a row for each task, go to one task in a
    single shuffle, which adds them up and orders them.
    """
    totals = [F.sum(column).alias(name) for name, column in sums.items()]
    known = df.where(F.col(label).isin(0, 1))
    return known.groupBy(label, group).agg(F.count(F.lit(1)).alias("flow_count"), *totals).coalesce(1).sortWithinPartitions(label, group)


def class_totals(df: DataFrame, *, group: str, amount: str) -> DataFrame:
    """Rows and the total of a positive amount per class, in order; classes are few."""
    positive = df.where(F.col(amount) > 0)
    return positive.groupBy(group).agg(F.count(F.lit(1)).alias("flow_count"), F.sum(amount).alias("total")).coalesce(1).sortWithinPartitions(group)


def class_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percentage of the positive class against everything else."""
    return df.sparkSession.sql(
        """
        SELECT if(coalesce(is_positive, false), 'Positive', 'Negative') AS traffic_class,
               flow_count,
               round(100.0D * flow_count / (SELECT count(*) FROM {rows}), 4) AS percentage
        FROM (SELECT {label} = 1 AS is_positive, count(*) AS flow_count FROM {rows} GROUP BY {label})
        ORDER BY flow_count DESC, traffic_class
        """,
        rows=df, label=F.col(label),
    )


def category_share(df: DataFrame, category: str, top: int) -> DataFrame:
    """The most frequent categories with their share of all rows."""
    return df.sparkSession.sql(
        """
        SELECT {category}, count(*) AS flow_count,
               round(100.0D * count(*) / (SELECT count(*) FROM {rows}), 4) AS percentage
        FROM {rows} GROUP BY {category}
        ORDER BY flow_count DESC, {category} LIMIT {top}
        """,
        rows=df, category=F.col(category), top=int(top),
    )


def positive_rate(df: DataFrame, group: str, top: int, label: str = "label") -> DataFrame:
    """Rows, positives and their percentage for the most frequent values of a column."""
    return df.sparkSession.sql(
        """
        SELECT {group}, count(*) AS flow_count, sum({label}) AS positive_count,
               round(100.0D * sum({label}) / count(*), 4) AS positive_percentage
        FROM {rows} GROUP BY {group}
        ORDER BY flow_count DESC, {group} LIMIT {top}
        """,
        rows=df, group=F.col(group), label=F.col(label), top=int(top),
    )


def numeric_profile(
    df: DataFrame, *, averages: Mapping[str, str], medians: Mapping[str, str], label: str = "label",
    digits: int = 2, median_digits: int = 6, accuracy: int = 10_000, digits_of: Mapping[str, int] | None = None,
) -> DataFrame:
    """Averages and approximate medians per class; the mappings give output names to columns.

    ``digits_of`` has the digits of single averages.
    """
    places = digits_of or {}
    mean = [F.round(F.avg(column), places.get(name, digits)).alias(name) for name, column in averages.items()]
    middle = [
        F.round(F.percentile_approx(column, 0.5, accuracy), median_digits).alias(name) for name, column in medians.items()
    ]
    return df.groupBy(label).agg(*middle, *mean).orderBy(label)


def exact_medians(df: DataFrame, column: str, group: str, *, accuracy: int = 10_000) -> DataFrame:
    """The exact lower median per group: the value at rank ceil(n / 2).

    A first pass brackets the median by two approximate percentiles. The second counts the rows
    below the bracket and ranks only the distinct values inside it, so no group is sorted whole.
    Values are compared as doubles.
    """
    margin = 2.0 / accuracy
    ends = F.percentile_approx(column, F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), accuracy)
    known = df.where(F.col(column).isNotNull()).select(group, column)
    bracket = known.groupBy(group).agg(ends.alias("ends"), F.ceil(F.count(F.lit(1)) / 2).alias("middle")).select(
        F.col(group).alias("_group"), F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"), "middle"
    )
    # one row per group; written, so that its real size decides between broadcast and shuffle
    bracket = written(bracket, "median-brackets")
    placed = known.join(bracket, F.col(group).eqNullSafe(F.col("_group"))).where(F.col(column) <= F.col("high"))
    inside = F.when(F.col(column) >= F.col("low"), F.col(column).cast("double"))
    values = placed.groupBy(group, "low", "high", "middle", inside.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    part = F.floor(F.try_divide(F.col("value") - F.col("low"), F.col("high") - F.col("low")) * 4096)
    slot = F.when(F.col("value").isNull(), -1).otherwise(F.coalesce(part, F.lit(0)))
    ranked = group_rank(values, [group], [F.asc_nulls_first("value")], slot, rank="first", weight=F.col("n"))
    reached = (F.col("first") <= F.col("middle")) & (F.col("middle") < F.col("first") + F.col("n"))
    found = ranked.where(reached).select(F.col(group).alias("_found"), "value")
    outside = F.raise_error(F.lit("median outside its bracket"))
    return bracket.join(found, F.col("_group").eqNullSafe(F.col("_found")), "left").select(
        F.col("_group").alias(group), F.coalesce("value", outside).alias("median")
    )


def label_correlations(df: DataFrame, columns: Sequence[str], top: int, label: str = "label") -> DataFrame:
    """Columns most correlated with the label, by absolute value; undefined ones are left out."""

    def correlation(column: str) -> Column:
        # corr itself divides by zero for a constant column, which is an error in ANSI mode
        x, y = F.col(column).cast("double"), F.col(label).cast("double")
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    row = df.agg(*[correlation(c).alias(c) for c in columns])
    pairs = row.select(long_rows([(c, F.col(c)) for c in columns], ("feature", "correlation")))
    finite = ~F.isnan("correlation") & (F.abs("correlation") < float("inf"))
    strength: Column = F.abs("correlation")
    return pairs.where(finite).orderBy(F.desc(strength), "feature").limit(top)


def imbalance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows of the largest and smallest class, and their ratio."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    high, low = F.max("n"), F.min("n")
    return counts.agg(high.alias("majority"), low.alias("minority"), (high / low).alias("ratio"))


def table_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """``item, detail, rows``: the columns with their types, and the rows per label."""
    no_count = F.lit(None).cast("bigint")
    schema = [
        (f"column {i} {f.name}", f.dataType.simpleString(), no_count) for i, f in enumerate(df.schema.fields, 1)
    ]
    names = ("item", "detail", "rows")
    columns = df.sparkSession.range(1).select(long_rows(schema, names))
    labels = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("label").alias("item"), F.col(label).cast("string").alias("detail"), "rows"
    )
    return columns.unionByName(labels)
