"""Deterministic samples per label, the first n rows by hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsight.functions.hashing import row_hash
from flowsight.operators.ranks import BEFORE, SLOT, group_rank, long_slot, slot_sizes
from flowsight.session import written


def first_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark cuts each task to ``n`` rows before the shuffle.

    That early cut is made up to the session's window group limit. Larger ``n`` gives the same rows
    without it, and sorts whole groups; ``hash_sample`` never does.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def hash_sample(df: DataFrame, label: str, key: Column, ties: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per label by the 64-bit hash ``key``, then by ``ties``.

    One way and one order for every ``n``: the hashes are counted in 65,536 ranges, all rows in ranges below the n-th row are kept as they are, and only the range that holds the
    n-th row is ordered; its copies are counted first, so many equal rows cost one row, and many
    different rows of one key are cut into parts again.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    columns = df.columns
    slotted = df.withColumn("_key", key).withColumn(SLOT, long_slot(F.col("_key")))
    last = F.max(F.struct(F.col(SLOT).alias("cut"), (F.lit(n) - F.col(BEFORE)).alias("need"))).alias("last")
    cuts = slot_sizes(slotted, [label]).where(F.col(BEFORE) < n).groupBy(F.col(label).alias("_label")).agg(last)
    # one row per label; written, so that its real size decides between broadcast and shuffle
    cuts = written(cuts.select("_label", "last.*"), "sample-cuts")
    candidates = slotted.join(cuts, F.col(label).eqNullSafe(F.col("_label")) & (F.col(SLOT) <= F.col("cut")))
    whole = candidates.where(F.col(SLOT) < F.col("cut")).select(*columns)
    copies = (
        candidates.where(F.col(SLOT) == F.col("cut")).groupBy(*columns, "_key", "need").agg(F.count(F.lit(1)).alias("_copies"))
    )
    # one identifier may have many different rows, so they are told apart by a hash of the row
    last_tie = row_hash(columns)
    slot = F.struct("_key", *ties, long_slot(last_tie))
    placed = group_rank(copies, [label], [F.col("_key"), *ties, last_tie], slot, rank="_first", weight=F.col("_copies"))
    left = F.col("need") - F.col("_first") + 1
    cut = (
        placed.where(left > 0).withColumn("_take", F.explode(F.sequence(F.lit(1), F.least(left, "_copies")))).select(*columns)
    )
    return whole.unionByName(cut)


def balanced_sample(
    df: DataFrame, *, identifier: str, label: str, per_label: int, columns: Sequence[str] | None = None, key: Column | None = None
) -> DataFrame:
    """The same rows every time: first ``per_label`` rows of each label by ``key``, else by the hash of all columns."""
    key = row_hash(columns or df.columns) if key is None else key
    return hash_sample(df, label, key, [F.col(identifier)], per_label)


def seeded_sample(
    df: DataFrame, *, identifier: str, label: str, limit: int, seed: int, key: Column | None = None
) -> DataFrame:
    """About ``limit`` rows, shared evenly between the labels, by ``key``, else by the hash of identifier and seed."""
    if limit < 2:
        raise ValueError("limit must be at least 2")
    labels = df.agg(F.count_distinct(label) + F.max(F.col(label).isNull().cast("int"))).first()[0]
    if not labels:
        raise ValueError("nothing to sample from")
    key = F.xxhash64(F.col(identifier), F.lit(int(seed))) if key is None else key
    return hash_sample(df, label, key, [F.col(identifier)], max(1, limit // labels))
