"""Periodic runs of words: stretches that repeat a block four times or more, found by a dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import map_batches, required
from flowsight.llm.words import blocks

# A run has at least this many words, and holds its period at least so often.
LEAST_WORDS = 6
LEAST_TIMES = 4
BLOCK_CHARS = 1_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass(frozen=True)
class Run:
    """``length`` words from ``start`` on, of which each equals the one ``period`` words later as long as that is in the run."""

    start: int
    length: int
    period: int


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts one after another, with a number of its own after each text; and where texts begin.

    Equal words of one text have equal numbers; words of different texts never have.
    """
    fresh = count()
    codes, starts, place = [], [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        starts.append(place)
        codes.extend([known[word] if word in known else known.setdefault(word, next(fresh)) for word in words])
        codes.append(next(fresh))
        place += len(words) + 1
    return np.array(codes, np.int64), np.array(starts, np.int64)


def repeated_groups(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again, ordered by key and place; the number of each one's key; which have a successor."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    follows = np.zeros(len(keys), bool)
    follows[1:] = keys[1:] == keys[:-1]
    followed = np.append(follows[1:], False)[: len(keys)]
    again = followed | follows
    return places[again], np.cumsum(~follows)[again], followed[again]


def progressions(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Rows ``start, end, period`` of stretches in which successive factors follow each other at one distance.

    Level by level, the factors of 1, 2, 4 ... words get names from the names of their halves; only
    factors that occur again in their text are kept. Where a factor's next occurrence is within
    twice its length, the distance is a possible period. Places with one distance in a row make an
    arithmetic progression of occurrences, and their factors cover a stretch with that period. A run
    of period q shows whole at the level whose factors are at least q and less than 2q words long,
    since the next occurrence of such a factor in the run is exactly q words on.
    """
    names = np.full(len(codes), -1, np.int64)
    places, name, followed = repeated_groups(codes, np.arange(len(codes)))
    size = 1
    while len(places):
        names[:] = -1
        names[places] = name
        steps = np.zeros(len(codes) + 1, np.int64)
        at = np.flatnonzero(followed)
        steps[places[at]] = places[at + 1] - places[at]
        steps[steps > 2 * size] = 0
        edges = np.flatnonzero(np.diff(steps, prepend=0))
        first, last = edges, np.append(edges[1:], len(steps)) - 1
        period = steps[first]
        covered = last - first + period + size
        whole = (period > 0) & (covered >= np.maximum(LEAST_WORDS, LEAST_TIMES * period))
        yield np.stack([first, first + covered, period], axis=1)[whole]
        if 4 * size > longest:
            return
        places = np.sort(places)
        places = places[places + size < len(codes)]
        places = places[names[places + size] >= 0]
        places, name, followed = repeated_groups(names[places] * len(codes) + names[places + size], places)
        size *= 2


def extended(codes: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The stretch made as long as its period allows on both sides; other texts are never reached, as their words differ."""
    step = 16
    while end < len(codes):
        equal = codes[end : end + step] == codes[end - period : end - period + min(step, len(codes) - end)]
        add = len(equal) if equal.all() else int(equal.argmin())
        end += add
        if add < step:
            break
        step *= 2
    step = 16
    while start > 0:
        low = max(0, start - step)
        equal = (codes[low:start] == codes[low + period : start + period])[::-1]
        add = len(equal) if equal.all() else int(equal.argmin())
        start -= add
        if add < step:
            break
        step *= 2
    return start, end


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text's words, by start and period."""
    codes, starts = numbered(texts)
    found: dict[tuple[int, int], int] = {}
    for proposed in progressions(codes, max(map(len, texts), default=0)):
        for start, end, period in proposed.tolist():
            stretch = extended(codes, start, end, period)
            # a stretch with several periods of four times or more is one run of the smallest
            found[stretch] = min(period, found.get(stretch, period))
    result: list[list[Run]] = [[] for _ in texts]
    spans = np.array(sorted((start, period, end) for (start, end), period in found.items()), np.int64).reshape(-1, 3)
    owners = np.searchsorted(starts, spans[:, 0], side="right") - 1
    for owner, (start, period, end) in zip(owners.tolist(), spans.tolist()):
        result[owner].append(Run(start - int(starts[owner]), end - start, period))
    return result


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    return [words[place] for place in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row, in one pass without a shuffle.

    Words are what ASCII white space separates, numbered from 0. ``runs`` has ``start, length,
    period`` of every run by start and period, ``collapsed`` the text of the words that no run holds
    after its first period, joined by one space. A null, empty or wordless text has no run and an
    empty ``collapsed``; a null doc_id stays null; repeated rows each have their row; an empty table
    gives an empty result; other columns are ignored. A text is held whole by one task, with
    memory in proportion to its words.
    """

    def convert(columns):
        ids, texts = columns
        words_of = [(value or "").encode().split() for value in texts]
        starts, lengths, periods, collapsed = [], [], [], []
        for block in blocks([value or "" for value in texts], BLOCK_CHARS):
            own = [words_of[place] for place in block]
            for words, runs in zip(own, runs_of(own)):
                starts.append([run.start for run in runs])
                lengths.append([run.length for run in runs])
                periods.append([run.period for run in runs])
                collapsed.append(b" ".join(without_repeats(words, runs) if runs else words).decode())
        return {
            "doc_id": ids, "n_words": [len(words) for words in words_of], "starts": starts, "lengths": lengths,
            "periods": periods, "collapsed": collapsed,
        }

    chosen = required(docs, doc_id, text)
    ddl = "doc_id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"
    found = map_batches(chosen.select(chosen[doc_id].cast("bigint"), chosen[text]), ddl, convert)
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", "n_words", runs.cast(RUNS).alias("runs"), "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equal ones; null where there is none."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast(RUNS.removeprefix("array<").removesuffix(">")), better)


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text, in every tenth document by ``crc32(doc_id)`` with a periodic tail that is made of its own words.

    With h the checksum, g = floor(h / 10), n the number of words, a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)), word i >= a becomes word a + (i - a) % p where h % 10 is 0.
    Texts without words, and rows without a doc_id, stay as they are.
    """
    words = F.regexp_extract_all(text, F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    hashed = F.crc32(doc_id.cast("string").cast("binary"))
    group = F.floor(hashed / 10).cast("bigint")

    def tail(found: Column) -> Column:
        total = F.size(found).cast("bigint")
        first = group % total
        period = 1 + F.floor((total - first) / (3 + group % 8)).cast("bigint")
        place = lambda i: F.when(i < first, i).otherwise(first + (i - first) % period)
        return F.transform(F.sequence(F.lit(0).cast("bigint"), total - 1), lambda i: F.get(found, place(i).cast("int")))

    # the array of words is bound to a name of its own, so that it is made once a text and not once a word
    planted = F.transform(F.array(words), lambda found: F.when(F.size(found) > 0, F.array_join(tail(found), " ")).otherwise(""))
    return F.when(doc_id.isNotNull() & (hashed % 10 == 0), planted[0]).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Of ``find_runs``: the number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
