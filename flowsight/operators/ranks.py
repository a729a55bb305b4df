"""Row numbers inside groups without putting a whole group into one task.

A plain ``row_number`` over a group sorts the group in one task. Here the rows of a group are
cut into slots that follow the order; rows are numbered inside their slot, and the number of
rows in the earlier slots is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT, BEFORE, TOTAL = "_slot", "_before", "_group_rows"


def slot_sizes(df: DataFrame, group: Sequence[str], weight: Column | None = None) -> DataFrame:
    """Rows per slot, with the rows of earlier slots and of the group."""
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.groupBy(*group, SLOT)
        .agg(size.alias("_slot_rows"))
        .withColumn(BEFORE, F.coalesce(F.sum("_slot_rows").over(earlier), F.lit(0)))
        .withColumn(TOTAL, F.sum("_slot_rows").over(whole))
    )


def group_rank(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    slot: Column,
    *,
    rank: str = "rank",
    total: str | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in the given order.

    ``slot`` must not decrease along the order, and should split a group into many parts. A row
    with a ``weight`` stands for that many equal rows and gets the number of the first of them.
    """
    # one struct as key: equal also where parts are NULL, and shared by the window and the join
    key = F.struct(*group, SLOT)
    slotted = df.withColumn(SLOT, slot).withColumn("_key_of_slot", key)
    inside = Window.partitionBy("_key_of_slot").orderBy(*order)
    if weight is None:
        place = F.row_number().over(inside)
    else:
        place = 1 + F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = slotted.withColumn("_inside", place)
    sizes = slot_sizes(slotted, group, weight).select(key.alias("_key_of_slot"), BEFORE, TOTAL)
    numbers = [(F.col(BEFORE) + F.col("_inside")).cast("bigint").alias(rank)]
    if total:
        numbers.append(F.col(TOTAL).cast("bigint").alias(total))
    return ranked.join(sizes, "_key_of_slot").select(*df.columns, *numbers)


def hex_slot(digest: Column, digits: int = 4) -> Column:
    """Slot of a hexadecimal digest: its first digits."""
    return F.substring(digest, 1, digits)


def long_slot(value: Column, bits: int = 16) -> Column:
    """Slot of a 64-bit hash: its highest bits, in signed order."""
    return F.shiftright(value, 64 - bits)
