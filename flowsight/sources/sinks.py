"""Batch writers and the read-back check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.functions.hashing import signature_figures
from flowsight.session import kept


def write_parquet(df: DataFrame, path: str, *, once: bool = True, partition_by: Sequence[str] = ()) -> None:
    """Snappy Parquet; ``once`` refuses a path that exists, otherwise it is overwritten."""
    mode = "errorifexists" if once else "overwrite"
    df.write.mode(mode).option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_csv_report(df: DataFrame, path: str, parts: int = 1) -> None:
    """A report as CSV with a header in each part: a single one for tables with a bounded number of rows, else at most ``parts``."""
    df.coalesce(parts).write.mode("overwrite").option("header", True).csv(path)


def write_checked(
    df: DataFrame, path: str, *, once: bool = True, partition_by: Sequence[str] = (), expected_rows: int | None = None,
    values: bool = False,
) -> DataFrame:
    """Write, read back, and require equal types and the expected number of rows, and with ``values`` equal values.

    Without ``expected_rows`` the rows of ``df`` are counted, which reads only the columns its filters need;
    the stored rows are counted from the file footers. With ``values`` the rows of ``df`` are held by the
    executors while they are written, so its plan runs once, and their signature is compared with that of the stored
    table; maps, which have no hash, are left out. (Figures observed during the write would need no holding, but a
    session that has observed can no longer serialise a fitted logistic regression.)
    """
    if values:
        with kept(df) as held:
            expected = signature_of(held)
            back = write_checked(held, path, once=once, partition_by=partition_by, expected_rows=expected["rows"])
        if expected_rows is not None and expected["rows"] != expected_rows:
            raise ValueError(f"{path} has {expected['rows']} rows, {expected_rows} expected")
        if signature_of(back) != expected:
            raise ValueError(f"{path} reads back other values than were written")
        return back
    write_parquet(df, path, once=once, partition_by=partition_by)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stored = df.sparkSession.read.parquet(path)
    # the type of a partition column is guessed from its folder names
    back = stored.withColumns({c: F.col(c).cast(types[c]) for c in partition_by}).select(*df.columns)
    changed = [f.name for f in back.schema.fields if f.dataType.simpleString() != types[f.name]]
    if changed:
        raise ValueError(f"types changed in {path}: {', '.join(changed)}")
    expected = df.count() if expected_rows is None else expected_rows
    found = back.count()
    if found != expected:
        raise ValueError(f"{path} reads back {found} rows, {expected} expected")
    return back


def signature_of(df: DataFrame) -> dict:
    """``rows`` and ``signature`` of a table, over all columns that can be hashed."""
    hashed = [field.name for field in df.schema.fields if "map<" not in field.dataType.simpleString()]
    return df.agg(*[figure.alias(name) for name, figure in signature_figures(hashed).items()]).first().asDict()
