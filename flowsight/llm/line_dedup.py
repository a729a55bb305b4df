"""Boilerplate lines by their frequency within a site; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import required, text_or_empty
from flowsight.session import written

WHITE = " \t\n\x0b\x0c\r"
MAX_RATIO = 0.01
MIN_PAGES = 5


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(WHITE))


def line_key(line: Column) -> Column:
    """128 bits of a line without the white space around it; blank lines have none."""
    body = trimmed(line)
    return F.when(F.length(body) > 0, F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("line"), body).alias("b")))


def boilerplate(pages: DataFrame, *, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``site, common``: the keys of the lines that more than ``max_ratio`` of a site's pages have, and at least ``min_pages``.

    Counts are added up in the tasks before the shuffle, so a site with very many pages or a very
    common line costs a row a task. A site has at most (mean lines of a page / ratio) such lines.
    """
    keys = F.array_distinct(F.array_compact(F.transform(F.split("text", "\n"), line_key)))
    lines = pages.select("site", F.explode(keys).alias("key")).select("site", "key.a", "key.b")
    counts = lines.groupBy("site", "a", "b").agg(F.count(F.lit(1)).alias("line_pages")).where(F.col("line_pages") >= min_pages)
    sites = pages.groupBy(F.col("site").alias("of_site")).agg(F.count(F.lit(1)).alias("site_pages"))
    common = counts.join(sites, F.col("site") == F.col("of_site")).where(F.col("line_pages") > max_ratio * F.col("site_pages"))
    return common.groupBy("site").agg(F.collect_set(F.struct("a", "b")).alias("common"))


def drop_boilerplate(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    host: str = "host",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``page_id, site, text, n_lines, n_dropped`` of every row: the text without its site's boilerplate lines.

    Lines are split at line feeds and compared without white space around them; a page counts once
    for a line however often it has it, and blank lines stay. A null host counts as the empty one, a
    null text as an empty text of one line; a null page_id stays null; repeated rows count as
    pages of their own; an empty table gives an empty result; other columns are ignored.

    The texts are read twice and shuffled only if the boilerplate table is too large to broadcast;
    its size is known by then, since it is written to the shared folder.
    """
    chosen = required(pages, page_id, host, text)
    rows = chosen.select(
        chosen[page_id].alias("page_id"),
        F.coalesce(chosen[host], F.lit("")).alias("site"),
        text_or_empty(chosen, text).alias("text"),
    )
    common = written(boilerplate(rows, max_ratio=max_ratio, min_pages=min_pages), "boilerplate")
    joined = rows.join(common.withColumnRenamed("site", "of_site"), F.col("site") == F.col("of_site"), "left")
    lines = F.split("text", "\n")
    known = F.coalesce(F.col("common"), F.array().cast("array<struct<a:bigint,b:bigint>>"))
    kept = F.filter(lines, lambda line: ~F.coalesce(F.array_contains(F.col("known"), line_key(line)), F.lit(False)))
    return (
        joined.withColumn("known", known)
        .select("page_id", "site", F.size(lines).cast("bigint").alias("n_lines"), kept.alias("kept"))
        .select(
            "page_id", "site", F.array_join("kept", "\n").alias("text"), "n_lines",
            (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        )
    )
