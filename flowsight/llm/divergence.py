"""Divergence of sources: how far the shares of terms of each source lie from those of the others and of the language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsight.llm.batches import arrow_schema, required, slices
from flowsight.operators.ranks import group_rank, long_slot
from flowsight.session import written

MIN_DOCS = 30
TOP_TERMS = 50
# A count is raised by this, and a share of 1 is this many parts.
PRIOR = 5
PARTS = 1_000_000_000
# Rows of the matrix and columns of it that one task compares; columns of a leaf of the tree.
ROWS = 64
LEAF = 32
COLUMNS = ROWS * LEAF
# Terms that a task adds up before it hands them on, and leaves that are compared at a time.
HELD_TERMS = 200_000
LEAVES = 8_192

# ASCII letters in lower case, other ASCII characters as spaces, bytes of other characters as they are.
LETTERS = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or 97 <= code <= 122 else 32 for code in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Stretches of ASCII letters and characters beyond ASCII; only A-Z are lower-cased."""
    return (text or "").encode().translate(LETTERS).split()


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` over all rows of ``lang, source, text``: occurrences, and documents that have the term."""
    schema = arrow_schema("lang string, source string, term string, n bigint, docs bigint")

    def emptied(tallies: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, held) in tallies.items():
            terms = pa.array(list(seen), pa.binary()).cast(pa.string())
            counts = pa.array(list(seen.values()), pa.int64()), pa.array([held[term] for term in seen], pa.int64())
            names = (pa.repeat(pa.scalar(name, pa.string()), len(seen)) for name in (lang, source))
            yield from slices(pa.RecordBatch.from_arrays([*names, terms, *counts], schema=schema), 50_000)
        tallies.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for part in slices(batch):
                for lang, source, text in zip(*(column.to_pylist() for column in part.columns)):
                    seen, held = tallies.setdefault((lang, source), (Counter(), Counter()))
                    words, before = terms_of(text), len(seen)
                    seen.update(words)
                    held.update(set(words))
                    size += len(seen) - before
                    if size > HELD_TERMS:
                        yield from emptied(tallies)
                        size = 0
        yield from emptied(tallies)

    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exactly, by long division so that no product leaves a long.

    Good for totals up to 9 x 10^15. Where there is no term the share is not defined, and 1 here.
    """
    whole = F.greatest(total + PRIOR * terms, F.lit(1))
    rest, value = F.when(terms > 0, count + PRIOR).otherwise(0), F.lit(0).cast("bigint")
    for _ in range(3):
        value = value * 1_000 + F.call_function("div", rest * 1_000, whole)
        rest = rest * 1_000 % whole
    return value + 1


class Prices:
    """A K-squared tree, K = 2, over the rows and columns of one part of the group-term matrix.

    ``shares`` has a row for each group and LEAF columns in each unit; what the matrix does not hold
    is the row's price of zero. ``held[0]`` says which units of a row hold anything, and
    ``held[l]`` which quadrants of 2^l rows and units do.
    """

    def __init__(self, side: int, units: int, zero: np.ndarray, row: np.ndarray, column: np.ndarray, price: np.ndarray):
        self.zero = zero
        self.shares = np.repeat(zero[:, None], units * LEAF, axis=1)
        self.shares[row, column] = price
        level = np.zeros((side, side), bool)
        level[row, column // LEAF] = True
        self.held = [level]
        while len(level) > 1:
            level = level[::2] | level[1::2]
            level = level[:, ::2] | level[:, 1::2]
            self.held.append(level)
        self.shares = self.shares.reshape(len(zero), units, LEAF)


def distances(left: Prices, right: Prices, same: bool) -> np.ndarray:
    """Sums of absolute differences of the shares of each row of ``left`` and each of ``right``.

    Both trees are walked together from their roots. Where neither has anything in a quadrant, all
    its columns are priced at once by the two prices of zero; other quadrants are split down to
    single rows and units. With ``same``, only pairs of a row and a later one are visited.
    """
    apart = np.abs(left.zero[:, None] - right.zero[None, :])
    sums = np.zeros(apart.shape, np.int64)
    units = left.shares.shape[1]
    a, b, c = (np.zeros(1, np.int64) for _ in range(3))
    empty = np.zeros((1, 1), np.int64)
    for level in range(len(left.held) - 1, -1, -1):
        nothing = ~(left.held[level][a, c] | right.held[level][b, c])
        width = np.minimum(units, (c + 1) << level) - (c << level)
        np.add.at(empty, (a[nothing], b[nothing]), width[nothing])
        a, b, c = a[~nothing], b[~nothing], c[~nothing]
        if level:
            a, b, c = (
                (2 * place[:, None] + np.array(half)).ravel()
                for place, half in ((a, [0, 0, 0, 0, 1, 1, 1, 1]), (b, [0, 0, 1, 1, 0, 0, 1, 1]), (c, [0, 1] * 4))
            )
            inside = (a << level - 1 < len(left.zero)) & (b << level - 1 < len(right.zero)) & (c << level - 1 < units)
            if same:
                inside &= a <= b
            a, b, c = a[inside], b[inside], c[inside]
            empty = empty.repeat(2, axis=0).repeat(2, axis=1)
    for low in range(0, len(a), LEAVES):
        x, y, z = (place[low : low + LEAVES] for place in (a, b, c))
        np.add.at(sums, (x, y), np.abs(left.shares[x, z] - right.shares[y, z]).sum(axis=1))
    return sums + empty[: sums.shape[0], : sums.shape[1]] * LEAF * apart


def part_distances(table: pa.Table) -> dict[str, np.ndarray]:
    """``a, b, value`` of all pairs of rows in one part of the matrix.

    ``side`` is 0 for the first block of rows, 1 for the second; ``col`` is -1 in the line that
    names a row and its price of zero. Rows and columns that hold much come first, so that empty
    quadrants are large; columns that hold nothing here are priced by their number.
    """
    side, row, col, price, width = (table[name].to_numpy() for name in ("side", "row", "col", "price", "width"))
    heads = col < 0
    seen, column = np.unique(col[~heads], return_inverse=True)
    by_use = np.argsort(np.argsort(-np.bincount(column, minlength=len(seen)), kind="stable"), kind="stable")
    units = max(1, -(-len(seen) // LEAF))
    most = max(units, *(int((heads & (side == number)).sum()) for number in (0, 1)))
    blocks, names = [], []
    for number in (0, 1):
        own, cells = heads & (side == number), ~heads & (side == number)
        found, held = np.unique(row[own], return_index=True)
        entries = np.searchsorted(found, row[cells])
        order = np.argsort(-np.bincount(entries, minlength=len(found)), kind="stable")
        place = np.argsort(order)
        names.append(found[order])
        blocks.append(Prices(
            1 << (most - 1).bit_length(), units, price[own][held][order], place[entries], by_use[column[cells[~heads]]], price[cells],
        ) if len(found) else None)
    same = blocks[1] is None
    left, right = blocks[0], blocks[0] if same else blocks[1]
    sums = distances(left, right, same)
    sums += (int(width[0]) - units * LEAF) * np.abs(left.zero[:, None] - right.zero[None, :])
    a, b = np.triu_indices(len(left.zero), 1) if same else (i.ravel() for i in np.indices(sums.shape))
    return {"a": names[0][a], "b": names[0 if same else 1][b], "value": sums[a, b]}


def matrix_parts(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """The cells, and a head for each row, in all the parts of the matrix that they belong to.

    A part is a band of columns and two blocks of rows, or one block with itself, so that it has
    at most 128 rows and 2,048 columns whatever the tables hold. A block of rows goes to as many
    parts as there are blocks; with up to 64 groups in a language there is one.
    """
    bands = F.greatest(F.lit(1), F.ceil(F.col("terms") / COLUMNS))
    own = F.call_function("div", F.col("row"), F.lit(ROWS))
    blocks = F.ceil(F.col("groups") / ROWS)
    heads = groups.select(
        "lang", "row", F.lit(-1).cast("bigint").alias("col"), F.col("zero").alias("price"), "groups", "terms",
        F.explode(F.sequence(F.lit(0).cast("bigint"), bands.cast("bigint") - 1)).alias("band"),
    )
    cells = cells.select(
        "lang", "row", "col", "price", "groups", "terms", F.call_function("div", F.col("col"), F.lit(COLUMNS)).alias("band")
    )
    width = F.least(F.lit(COLUMNS), F.col("terms") - F.col("band") * COLUMNS).cast("bigint")
    placed = heads.unionByName(cells).select(
        "lang", "band", "row", "col", "price", width.alias("width"), own.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks.cast("bigint") - 1)).alias("other"),
    )
    return placed.select(
        "lang", "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).cast("bigint").alias("side"), "row", "col", "price", "width",
    )


def group_distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every pair of rows a <> b of a language, in both directions."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = part_distances(table)
        langs = pa.repeat(pa.scalar(key[0].as_py(), pa.string()), len(found["a"]))
        return pa.table({"lang": langs, **{name: pa.array(values, pa.int64()) for name, values in found.items()}})

    parts = matrix_parts(cells, groups).groupBy("lang", "band", "low", "high")
    once = parts.applyInArrow(run, "lang string, a bigint, b bigint, value bigint")
    summed = once.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value"))
    return summed.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("pair"), "value").select(
        "lang", "pair.a", "pair.b", "value"
    )


def matrix(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The groups and the cells of the group-term matrix, as written tables.

    ``groups``: ``lang, source, row, groups, total, terms, zero``. ``cells``: ``lang, source, row, term, col,
    n, price, lang_price``, only where n > 0. Rows and columns are numbered from 0 in each language.
    """
    counts = written(count_terms(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= min_docs).select("lang", "term", "in_lang", F.xxhash64("term").alias("place"))
    numbered = group_rank(kept, ["lang"], [F.col("place"), F.col("term")], long_slot(F.col("place"), 12), total="terms")
    numbered = written(numbered.select("lang", "term", "in_lang", "terms", (F.col("rank") - 1).alias("col")), "kept-terms")
    langs = numbered.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.max("terms").alias("terms"))
    priced = numbered.drop("terms").join(langs, "lang").withColumn(
        "lang_price", share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    )
    hits = written(
        counts.drop("docs").join(priced.select("lang", "term", "col", "lang_price"), ["lang", "term"]), "kept-counts"
    )
    totals = hits.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(
        langs.select("lang", "terms"), "lang", "left"
    )
    groups = groups.select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"),
        F.xxhash64("source").alias("place"),
    ).withColumn("zero", share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms")))
    groups = group_rank(groups, ["lang"], [F.col("place"), F.col("source")], long_slot(F.col("place"), 12), total="groups")
    groups = written(groups.withColumn("row", F.col("rank") - 1).drop("place", "rank"), "groups")
    cells = hits.join(groups, ["lang", "source"]).withColumn("price", share(F.col("n"), F.col("total"), F.col("terms")))
    return groups, cells


def audit(
    docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of a language and a source.

    A language keeps the terms that at least ``min_docs`` of its documents have. A group's share of a
    kept term is 1 + floor(10^9 (n + 5) / (N + 5 V)), N its occurrences of the V kept terms. Part
    ``pair`` has each other source of the language, with the sum over all kept terms of the
    absolute differences of the two shares (0 where no term is kept). Part ``term`` has the
    ``top_terms`` terms of the group whose share is above that of the whole language, with the
    difference. Ranks go from 1 by value, greatest first, and then by item.

    A null language, source or text is an empty one. Texts without terms make no counts, but their
    group is there. Repeated rows count as often as they occur; an empty table gives an empty result;
    other columns are ignored.
    """
    docs = required(docs, lang, source, text).toDF("lang", "source", "text").na.fill("")
    groups, cells = matrix(docs, min_docs)
    cells = written(cells.select("lang", "source", "row", "groups", "term", "col", "terms", "price", "lang_price"), "cells")
    names = groups.select("lang", "row", "source")
    pairs = (
        group_distances(cells, groups)
        .join(names.select("lang", F.col("row").alias("a"), "source"), ["lang", "a"])
        .join(names.select("lang", F.col("row").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    above = cells.where("price > lang_price").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("price") - F.col("lang_price")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    # the limit is applied in each task before the shuffle
    above = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(above)
