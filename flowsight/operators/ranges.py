"""Ranges of an order that hold a bounded number of rows each, found by repeated sampling.

Sorting a whole table to number its rows, or to cut a slice out of the middle, sends every row
through the sort. Here borders are drawn from a sample of the rows, the rows of every range are
counted, and only ranges that are too large are cut again, by borders of their own. Skew does no
harm: borders are drawn by rows and not by values, they compare whole rows where the order columns
are equal, and a row that equals a border is in a range of equal rows that needs no cutting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsight.session import written

RANGE, KEY = "_range", "_order_key"
# Rows that a task may have to order, and borders of a range that is cut.
ROWS = 250_000
BORDERS = 63
# Draws that are sorted, in borders; the borders are the least of them.
DRAWN = 8
DIGITS = 3


def total_order(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns, NULL first, and then all others after a hash of the row: equal keys are equal rows."""
    rest = [name for name in df.columns if name not in order]
    return F.struct(*order, F.xxhash64(*df.columns).alias("_tie"), *rest)


def borders_below(borders: Column, key: Column) -> Column:
    """How many of the sorted borders are not above the key, by bisection."""
    steps = [1 << power for power in range(BORDERS.bit_length() - 1, -1, -1)]

    def step(found: Column, width: Column) -> Column:
        reach = found + width
        return F.when((reach <= F.size(borders)) & (F.get(borders, reach - 1) <= key), reach).otherwise(found)

    return F.reduce(F.array(*[F.lit(width) for width in steps]), F.lit(0), step)


def cut_ranges(keyed: DataFrame, group: Sequence[str], chosen: DataFrame) -> DataFrame:
    """The rows with the name of their range made longer where ``chosen`` (groups, ranges and their rows) has it.

    Of m borders come 2m + 1 ranges: between the borders, with even numbers, and of the rows
    that equal a border, with odd ones. Names go up with the order.
    """
    names = F.struct(*group, RANGE)
    picked = written(chosen.select(names.alias("_cut"), F.col("rows").alias("_rows")), "ranges-to-cut")
    marked = keyed.withColumn("_cut", names)
    # a uniform sample of rows, so borders follow how the rows lie; it settles the borders only. The least draws are
    # taken, and only draws among which they must be are sorted.
    draw = F.xxhash64(F.monotonically_increasing_id(), F.lit(17))
    drawn = marked.withColumn("_draw", draw).join(picked, "_cut").where(
        (F.col("_draw") / 2.0**64 + 0.5) * F.col("_rows") <= DRAWN * BORDERS
    )
    few = Window.partitionBy("_cut").orderBy("_draw")
    drawn = drawn.select("_cut", KEY, "_draw").withColumn("_place", F.row_number().over(few)).where(F.col("_place") <= BORDERS)
    borders = drawn.groupBy("_cut").agg(F.array_sort(F.collect_set(KEY)).alias("_borders"))
    borders = written(borders, "borders")
    below = borders_below(F.col("_borders"), F.col(KEY))
    equal = F.get("_borders", F.col("_below") - 1) == F.col(KEY)
    number = 2 * F.col("_below") - F.when(equal, 1).otherwise(0)
    name = F.concat(F.col(RANGE), F.lpad(number.cast("string"), DIGITS, "0"))
    cut = marked.join(borders, "_cut", "left").withColumn("_below", below)
    return cut.withColumn(RANGE, F.when(F.col("_borders").isNull(), F.col(RANGE)).otherwise(name)).select(*keyed.columns)


def of_equal_rows() -> Column:
    """Whether a range was made for the rows that equal a border."""
    return (F.length(RANGE) > 0) & (F.substring(RANGE, -1, 1).cast("int") % 2 == 1)


def range_counts(ranged: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return written(ranged.groupBy(*group, RANGE).agg(F.count(F.lit(1)).alias("rows")), "range-counts")


def adaptive_ranges(keyed: DataFrame, group: Sequence[str] = (), *, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows with a column ``RANGE`` whose text goes up with ``KEY``, and the rows of each range.

    No range has more than ``rows`` rows of a group unless they are all equal.
    """
    ranged = keyed.withColumn(RANGE, F.lit(""))
    while True:
        counts = range_counts(ranged, group)
        large = counts.where((F.col("rows") > rows) & ~of_equal_rows())
        if large.isEmpty():
            return ranged, counts
        # finding the range of a row is dear, and it is needed several times
        ranged = written(cut_ranges(ranged, group, large), "ranged")


def with_places(counts: DataFrame) -> DataFrame:
    """``first, last``: the ranks from 0 that the rows of each range have, without groups; one row a range."""
    up_to = Window.partitionBy(F.lit(0)).orderBy(RANGE)
    last = F.sum("rows").over(up_to)
    return counts.withColumn("last", last - 1).withColumn("first", last - F.col("rows"))


def rank_slice(df: DataFrame, order: Sequence[str], start: int, stop: int, *, rows: int = ROWS) -> DataFrame:
    """The rows with the ranks ``start`` to ``stop`` - 1, counted from 0 in the order of the columns, NULL first.

    Rows that are equal in the order columns are ordered by a hash of the whole row, so slices of one
    table never overlap. The rows are written with the name of their range, which is dear to find, and only ranges
    that hold an end of the slice are cut and written again; ranges inside are taken as they are, and at most ``rows``
    rows of each end are ordered. So the cost does not depend on where the slice lies. The table is read three times
    and should be a written one.
    """
    if not 0 <= start <= stop:
        raise ValueError(f"no slice from {start} to {stop}")
    key = total_order(df, order)
    ranged = df.withColumn(KEY, key).withColumn(RANGE, F.lit(""))
    # the ranges that were looked at before lie between those that have been cut out of them, and only count
    earlier, parts = None, [df.limit(0)]
    while True:
        counts = range_counts(ranged).withColumn("new", F.lit(True))
        placed = with_places(counts if earlier is None else counts.unionByName(earlier))
        take = F.least(F.lit(stop), F.col("last") + 1) - F.greatest(F.lit(start), F.col("first"))
        skip = F.greatest(F.lit(start) - F.col("first"), F.lit(0))
        placed = written(placed.select(RANGE, "rows", "new", skip.alias("skip"), take.alias("take")), "slice-ranges")
        # the two ends at most
        ends = placed.where("new and take > 0 and take < rows")
        edges = ends.withColumn("cut", (F.col("rows") > rows) & ~of_equal_rows()).collect()
        # of the uncut table there is nothing to take as it is, unless the slice is all of it
        if earlier is not None or not edges:
            inside = placed.where("new and take = rows").select(RANGE)
            parts.append(ranged.join(inside, RANGE, "left_semi").select(*df.columns))
        names = [edge[RANGE] for edge in edges]
        own = ranged.where(F.col(RANGE).isin(names))
        if not any(edge["cut"] for edge in edges):
            break
        earlier = placed.where(~F.col(RANGE).isin(names)).select(RANGE, "rows", F.lit(False).alias("new"))
        cut = cut_ranges(own, (), ends.where((F.col("rows") > rows) & ~of_equal_rows()))
        ranged = written(cut.select(*df.columns, RANGE), "ranged").withColumn(KEY, key)
    for edge in edges:
        end = own.where(F.col(RANGE) == edge[RANGE])
        if edge["rows"] <= rows:
            end = end.orderBy(KEY).offset(edge["skip"])
        parts.append(end.limit(edge["take"]).select(*df.columns))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def rows_up_to(df: DataFrame, order: Sequence[str], stop: int, **options) -> DataFrame:
    """The first ``stop`` rows in the order of the columns."""
    return rank_slice(df, order, 0, stop, **options)
