"""Audits of a table. Each report is a table of its own, from as few passes as possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.contract import Contract, RawLayout, require_columns, same_types
from flowsight.functions.hashing import bit_marks, has_mark, row_digest
from flowsight.functions.predicates import label_known, long_rows, missing_text, rows_where, target_broken, unusable_number


def null_counts(df: DataFrame) -> DataFrame:
    """``column_name, null_rows`` for every column, in one pass."""
    row = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return row.select(long_rows([(name, F.col(name)) for name in df.columns], ("column_name", "null_rows")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, distinct_values``, NULL not counted."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return row.select(long_rows([(c, F.col(c)) for c in columns], ("column_name", "distinct_values")))


def copies(df: DataFrame, columns: Sequence[str] | None = None, checks: Sequence[Column] = ()) -> DataFrame:
    """``copies`` of each distinct row, and the ``checks`` it meets as bits in ``marks_0, marks_1 ...``.

    Only two hashes of a row and the bits are shuffled, whatever the number and width of its columns.
    """
    keys = {f"digest_{i}": digest for i, digest in enumerate(row_digest(columns or df.columns))}
    keys |= {f"marks_{i}": marks for i, marks in enumerate(bit_marks(checks))}
    digests = df.select(*[column.alias(name) for name, column in keys.items()])
    return digests.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def marked_rows(counted: DataFrame, place: int) -> Column:
    """How many rows meet the check at a place, of the table that ``copies`` made."""
    marks = [name for name in counted.columns if name.startswith("marks_")]
    return F.coalesce(F.sum(F.when(has_mark(marks, place), F.col("copies")).otherwise(0)), F.lit(0))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``rows, distinct_rows, duplicate_rows``."""
    return copies(df, columns).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def label_audit(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, rows, valid``; NULL is a value of its own."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "valid", label_known("label")
    )


def cleaning_audit(df: DataFrame, contract: Contract) -> DataFrame:
    """``check_name, column_name, rows``: what cleaning would drop, replace and keep.

    The checks of a row are bits beside its digest; copies are counted once per distinct row and
    weighted. So the table is read once, and a few longs a row are shuffled.
    """
    checks = [("unusable_number", c, unusable_number(c, floating=contract.is_floating(c))) for c in contract.numeric]
    checks += [("missing_text", c, missing_text(c)) for c in contract.categorical]
    checks.append(("broken_target", contract.label, target_broken(contract)))
    counted = copies(df, contract.columns, [bad for _, _, bad in checks])
    marks = [name for name in counted.columns if name.startswith("marks_")]
    n = F.col("copies")
    row = counted.agg(
        F.sum(n).alias("rows"),
        F.sum(n - 1).alias("duplicates"),
        F.count_if(~has_mark(marks, len(checks) - 1)).alias("kept"),
        *[marked_rows(counted, i).alias(f"check_{i}") for i in range(len(checks))],
    )
    figures = [("all_rows", "", F.col("rows")), ("kept_rows", "", F.col("kept")), ("duplicate_row", "", F.col("duplicates"))]
    figures += [(kind, column, F.col(f"check_{i}")) for i, (kind, column, _) in enumerate(checks)]
    names = ("check_name", "column_name", "rows")
    return row.select(long_rows([(k, c, F.coalesce(v, F.lit(0))) for k, c, v in figures], names))


def require_clean(audit: DataFrame) -> None:
    """Fail if any check of a cleaning audit counted a row."""
    problems = ~F.col("check_name").isin("all_rows", "kept_rows") & (F.col("rows") > 0)
    bad = audit.where(problems).collect()
    if bad:
        raise ValueError("not clean: " + ", ".join(f"{r.check_name} {r.column_name} {r.rows}" for r in bad))


def key_groups(df: DataFrame, key: str, label: str) -> DataFrame:
    """One row per key: its rows, its lowest and highest label, and its rows with a label."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(label).alias("labelled_rows"),
        F.min(label).alias("low_label"),
        F.max(label).alias("high_label"),
    )


def key_audit(df: DataFrame, key: str = "flow_fingerprint", label: str = "label") -> DataFrame:
    """Rows, distinct keys, duplicate rows, and keys that occur with more than one label.

    A missing label counts as a label of its own here.
    """
    require_columns(df, [key, label])
    differs = F.coalesce(F.col("low_label") != F.col("high_label"), F.lit(False))
    partly = (F.col("labelled_rows") > 0) & (F.col("labelled_rows") < F.col("rows"))
    groups = key_groups(df, key, label).withColumn("conflict", differs | partly)
    zero = F.lit(0)
    return groups.agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), zero).alias("duplicate_rows"),
        F.count_if("conflict").alias("conflicting_keys"),
        F.coalesce(F.sum(F.when(F.col("conflict"), F.col("rows"))), zero).alias("conflicting_rows"),
    )


def token_audit(canonical: DataFrame, layout: RawLayout) -> DataFrame:
    """``column_name, malformed_rows, missing_rows`` for the number columns of the raw table."""
    names = layout.numeric
    row = canonical.agg(
        *[F.count_if(F.array_contains("malformed_fields", c)).alias(f"malformed_{c}") for c in names],
        *[F.count_if(F.array_contains("missing_fields", c)).alias(f"missing_{c}") for c in names],
    )
    cells = [(c, F.col(f"malformed_{c}"), F.col(f"missing_{c}")) for c in names]
    return row.select(long_rows(cells, ("column_name", "malformed_rows", "missing_rows")))


def source_counts(df: DataFrame, source: str = "source_file", label: str = "label") -> DataFrame:
    """Rows per source, with the rows whose label is not 0 or 1."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"), rows_where(~label_known(label)).alias("invalid_label_rows")
    )


def count_reconciliation(df: DataFrame, *, verified_rows: int, published_rows: int) -> DataFrame:
    """The row count against the verified count, and its difference from the published one."""
    return df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        "actual_rows",
        F.lit(int(verified_rows)).cast("bigint").alias("verified_rows"),
        F.lit(int(published_rows)).cast("bigint").alias("published_rows"),
        (F.col("actual_rows") - published_rows).alias("difference_from_published"),
        (F.col("actual_rows") == verified_rows).alias("matches_verified"),
    )


def require_count(df: DataFrame, *, verified_rows: int, published_rows: int) -> DataFrame:
    report = count_reconciliation(df, verified_rows=verified_rows, published_rows=published_rows)
    row = report.first()
    if not row.matches_verified:
        raise ValueError(f"{row.actual_rows} rows, {verified_rows} expected")
    return report


def validation_report(df: DataFrame, contract: Contract, *, expected_rows: int) -> DataFrame:
    """``check_name, value, passed`` for a table that was just read against its contract."""
    counted = copies(df, checks=[~label_known(contract.label), *[F.col(c).isNull() for c in df.columns]])
    n = F.col("copies")
    row = counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicates"),
        marked_rows(counted, 0).alias("bad_labels"),
        *[marked_rows(counted, place).alias(f"null_{c}") for place, c in enumerate(df.columns, 1)],
    )
    shape = same_types(df.schema, contract.schema) and df.columns == contract.columns
    figures = [
        ("row_count", F.col("rows"), F.col("rows") == expected_rows),
        ("column_count", F.lit(len(df.columns)).cast("bigint"), F.lit(shape)),
        ("duplicate_rows", F.col("duplicates"), F.lit(None).cast("boolean")),
        ("invalid_labels", F.col("bad_labels"), F.col("bad_labels") == 0),
    ]
    figures += [(f"null_{c}", F.col(f"null_{c}"), F.lit(None).cast("boolean")) for c in df.columns]
    return row.select(long_rows(figures, ("check_name", "value", "passed")))


def require_valid(report: DataFrame) -> None:
    bad = report.where(~F.col("passed")).collect()
    if bad:
        raise ValueError("validation failed: " + ", ".join(f"{r.check_name} = {r.value}" for r in bad))
