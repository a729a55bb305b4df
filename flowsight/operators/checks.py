"""Equality of results: signatures that do not depend on order or partitioning."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsight.functions.hashing import signature_figures
from flowsight.session import kept, written
from flowsight.sources.readers import union_all


def signature(df: DataFrame) -> DataFrame:
    """One row: ``rows, signature``. Round floating columns first if their sums may vary."""
    return df.agg(*[figure.alias(name) for name, figure in signature_figures(df.columns).items()])


def compare_variants(variants: Mapping[str, DataFrame]) -> DataFrame:
    """``variant, rows, signature, same``: whether each variant equals the first one."""
    parts = [
        signature(df).select(F.lit(name).alias("variant"), "rows", "signature", F.lit(place).alias("_place"))
        for place, (name, df) in enumerate(variants.items())
    ]
    result = F.struct("rows", "signature")
    first = F.first(result).over(Window.partitionBy(F.lit(0)).orderBy("_place"))  # one row per variant
    return union_all(parts).withColumn("same", result == first).drop("_place")


def with_verdict(variants: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all variants, with the ``variant`` they are of and whether that is the ``same`` as the first one."""
    stored = {name: written(df, "variant") for name, df in variants.items()}
    verdict = compare_variants(stored).select("variant", "same")
    rows = union_all([df.select(F.lit(name).alias("variant"), "*") for name, df in stored.items()])
    return rows.join(verdict, "variant").select("variant", "same", *next(iter(stored.values())).columns)


def plan_of(df: DataFrame) -> str:
    """The plan as ``explain`` prints it."""
    with redirect_stdout(StringIO()) as printed:
        df.explain("formatted")
    return printed.getvalue()


def read_and_kept(inputs: Mapping[str, DataFrame], query: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """The query on each input read anew, and on the same input held by the executors, as written tables.

    What is held is let go again whatever happens; it is an error if the query does not use it.
    """
    found = {}
    for name, df in inputs.items():
        found[name] = written(query(df), "variant")
        with kept(df) as held:
            held.count()
            again = query(held)
            if "InMemoryTableScan" not in plan_of(again):
                raise ValueError(f"{name}: the query does not read the rows that are held")
            found[f"{name}, kept"] = written(again, "variant")
    return found


def partition_invariance(df: DataFrame, query: Callable[[DataFrame], DataFrame], counts: Sequence[int]) -> DataFrame:
    """Run ``query`` on ``df`` in each of the partition counts and compare the results."""
    return compare_variants({str(n): query(df.repartition(n)) for n in counts})


def growth_invariance(
    df: DataFrame, query: Callable[[DataFrame], DataFrame], *, order: Sequence[str], sizes: Sequence[int], counts: Sequence[int]
) -> DataFrame:
    """The partition check on short prefixes in a fixed order, then on the whole table.

    A prefix passes through one task, so ``sizes`` are for small tables of a growth curve.
    """
    inputs = [(F.lit(size), df.orderBy(*order).limit(size)) for size in sizes]
    inputs.append((F.lit(None), df))
    reports = [
        partition_invariance(part, query, counts).withColumn("prefix_rows", size.cast("bigint")) for size, part in inputs
    ]
    return union_all(reports)


def require_same(report: DataFrame) -> None:
    wrong = [row.variant for row in report.where(~F.col("same")).collect()]
    if wrong:
        raise ValueError(f"results differ: {', '.join(wrong)}")
