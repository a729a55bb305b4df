"""Language of texts by bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsight.llm.batches import arrow_schema, filter_batches, map_batches, required
from flowsight.llm.words import blocks, forget
from flowsight.session import written

UNKNOWN = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 1_000_000


@dataclass(frozen=True)
class Settings:
    """``n``: letters of an n-gram. ``model_bytes``: what the filter may take at most, however many languages
    there are and however much text is learned from; each language has its most common n-grams in it, ``most_keys``
    of them or fewer if the bytes ask for it. ``most_langs``: languages that are learned, those with
    the most n-grams if there are more. ``min_ratio``: the least share of the rate that the n-gram has where it is most
    common, so that stray words of other languages do not count. ``hashes``, ``slots_per_key``: the filter."""

    n: int = 4
    model_bytes: int = 64 << 20
    most_keys: int = 20_000
    most_langs: int = 1_000
    min_ratio: float = 0.2
    hashes: int = 3
    slots_per_key: int = 16

    def keys_per_lang(self, langs: int) -> int:
        """So many that all languages' slots, of a bit a language each, fit the bytes of the model."""
        return max(1, min(self.most_keys, self.model_bytes // (self.slots_per_key * langs * -(-langs // 8))))


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


# First and last code points of scripts that put no spaces between words.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)


@cache
def unspaced() -> np.ndarray:
    """Which code points are letters of scripts without spaces."""
    table = np.zeros(0x110000, bool)
    for low, high in UNSPACED:
        table[low : high + 1] = letters()[low : high + 1]
    return table


def mixed_keys(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(29))) * MIX
    return keys ^ (keys >> np.uint64(32))


def ngrams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the n-grams of the lower-cased texts, and the number of the text of each.

    What is not a letter is a space; an n-gram may begin and end with a space but has none within. In
    scripts without spaces, where most n-grams of a text are rare, pairs of letters are taken instead.
    """
    lowered = [f" {text.lower()} " for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(text) for text in lowered])
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, 32).astype(np.uint64)
    spans = len(codes) - n + 1
    if spans < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    dense = unspaced()[codes]
    whole = np.ones(spans, bool)
    keys = np.zeros(spans, np.uint64)
    for step in range(n):
        if 0 < step < n - 1:
            whole &= is_letter[step : step + spans]
        keys = keys * np.uint64(0x1000003) + codes[step : step + spans]
    if not dense.any():
        return mixed_keys(keys[whole]), owner[:spans][whole]
    for step in range(n):
        whole &= ~dense[step : step + spans]
    pairs = np.flatnonzero(dense[:-1] & dense[1:])
    both = np.concatenate([keys[whole], (codes[pairs] << np.uint64(32)) + codes[pairs + 1]])
    return mixed_keys(both), np.concatenate([owner[:spans][whole], owner[pairs]])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Tally:
    """Counts of keys, folded together whenever many have gathered."""

    def __init__(self, fold_at: int = 1_000_000):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.fold_at = 0, fold_at

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.held += len(self.parts[-1][0])
            if self.held > self.fold_at:
                self.fold()
                self.fold_at = max(self.fold_at, 2 * self.held)

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(column) for column in zip(*self.parts))
        self.parts = [summed(keys, counts)]
        self.held = len(self.parts[0][0])
        return self.parts[0]


def count_ngrams(labelled: DataFrame, settings: Settings) -> DataFrame:
    """``lang, key, n`` over all rows of ``text, lang``, added up in the tasks before the shuffle."""
    schema = arrow_schema("lang string, key bigint, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tallies: dict[str, Tally] = {}
        for batch in batches:
            texts, langs = (column.to_pylist() for column in batch.columns)
            texts = [text or "" for text in texts]
            for block in blocks(texts, BLOCK_CHARS):
                by_lang: dict[str, list[str]] = {}
                for place in block:
                    by_lang.setdefault(langs[place], []).append(texts[place])
                for lang, own in by_lang.items():
                    tallies.setdefault(lang, Tally()).add(ngrams(own, settings.n)[0])
        for lang, tally in tallies.items():
            if not tally.parts:
                continue
            keys, counts = tally.fold()
            for low in range(0, len(keys), 100_000):
                part = keys[low : low + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part), pa.array(counts[low : low + 100_000].astype(np.int64))],
                    schema=schema,
                )

    counted = labelled.select("text", "lang").mapInArrow(run, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """A row of ``slices`` for each slot; bit l of a row says that language l may have an n-gram there.

    ``coverage`` is the share of a language's own n-grams that the filter has.
    """

    langs: list[str]
    common: str
    slices: np.ndarray
    false_rates: np.ndarray
    coverage: np.ndarray
    settings: Settings


def slots(keys: np.ndarray, number: int, size: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(2 * number + 0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(33)) % np.uint64(size)


def build_filters(members: list[tuple[str, int, int]], totals: dict[str, int], settings: Settings) -> Model:
    """Filters from ``(lang, key, n)`` and the number of n-grams seen in each language."""
    langs = sorted(totals)
    number = {lang: place for place, lang in enumerate(langs)}
    keys = np.array([key for _, key, _ in members], np.int64).view(np.uint64)
    owners = np.array([number[lang] for lang, _, _ in members], np.int64)
    size = max(64, settings.slots_per_key * len(np.unique(keys)))
    slices = np.zeros((size, -(-len(langs) // 8)), np.uint8)
    for probe in range(settings.hashes):
        np.bitwise_or.at(slices, (slots(keys, probe, size), owners // 8), (1 << owners % 8).astype(np.uint8))
    # a byte column at a time, so that the bits are never unpacked all at once
    filled = [np.unpackbits(slices[:, column, None], axis=1, bitorder="little").mean(axis=0) for column in range(slices.shape[1])]
    rates = (np.concatenate(filled) if filled else np.zeros(0))[: len(langs)] ** settings.hashes
    held = np.bincount(owners, weights=[n for _, _, n in members], minlength=len(langs))
    coverage = held / np.array([max(1, totals[lang]) for lang in langs]) if langs else np.zeros(0)
    common = min(langs, key=lambda lang: (-totals[lang], lang)) if langs else UNKNOWN
    return Model(langs, common, slices, rates, np.maximum(coverage, 1e-9), settings)


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from all rows of ``text, lang``; null texts count as empty, rows without a language are left out.

    Every n-gram of every row is counted. Which of them belong to a language does not depend on how
    much text there is: its most common ones do, as many as fit the model, so that what comes to the driver
    and is broadcast later has a fixed bound (``Settings.model_bytes``). Of n-grams that are equally
    common, all belong or none. Repeated rows count as often as they occur; from an empty table
    nothing is learned; other columns are ignored.
    """
    counts = count_ngrams(required(labelled, "text", "lang").where("lang is not null"), settings)
    counts = written(counts, "ngrams")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    found = sums.orderBy(F.desc("total"), "lang").limit(settings.most_langs).collect()
    totals = {row["lang"]: row["total"] for row in found}
    if not totals:
        return build_filters([], {}, settings)
    most = settings.keys_per_lang(len(totals))
    langs = labelled.sparkSession.createDataFrame(list(totals.items()), "lang string, total bigint")
    # how many n-grams of a language are at least so common, by steps of a sixteenth of a power of two
    step = F.floor(16 * F.log2("n")).cast("int")
    steps = counts.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("keys"))
    above = Window.partitionBy("lang").orderBy(F.desc("step"))
    steps = steps.withColumn("keys", F.sum("keys").over(above)).where(F.col("keys") <= most)
    least = langs.join(steps.groupBy("lang").agg(F.min("step").alias("least")), "lang")
    common = counts.join(F.broadcast(least), "lang").where(step >= F.col("least"))
    rated = written(common.select("lang", "key", "n", (F.col("n") / F.col("total")).alias("rate")), "common-ngrams")
    best = rated.groupBy("key").agg(F.max("rate").alias("best"))
    chosen = rated.join(best, "key").where(F.col("rate") >= settings.min_ratio * F.col("best")).select("lang", "key", "n")
    table = chosen.toArrow()
    return build_filters(list(zip(*(table[name].to_pylist() for name in ("lang", "key", "n")))), totals, settings)


def hit_counts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of each text, and how many of them each language has."""
    keys, owner = ngrams(texts, model.settings.n)
    size = len(model.slices)
    found = model.slices[slots(keys, 0, size)]
    for probe in range(1, model.settings.hashes):
        found = found & model.slices[slots(keys, probe, size)]
    hits = np.zeros((len(texts), len(model.langs)), np.int64)
    for column in range(found.shape[1]):
        table = np.bincount(owner * 256 + found[:, column], minlength=256 * len(texts)).reshape(-1, 256)
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        part = table @ bits
        hits[:, 8 * column : 8 * column + 8] = part[:, : len(model.langs) - 8 * column]
    return np.bincount(owner, minlength=len(texts)), hits


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text.

    The share of a text's n-grams that a language has is corrected for the filter's false positives, and
    divided by the share that the language has of its own texts: a text that is as good as those has 1,
    also in a script without spaces, where the most common n-grams make up little of a text. The
    score is the largest such quotient, 1 at most. A null text or one without a letter is
    ``und`` with score 0, and so is every text if nothing was learned. Where no language has any of
    the n-grams, the answer is the language with the most n-grams, with score 0; equal shares go to
    the language that is first by name.
    """
    langs, scores = [], []
    texts = [text or "" for text in texts]
    for block in blocks(texts, BLOCK_CHARS):
        own = [texts[place] for place in block]
        totals, hits = hit_counts(model, own) if model.langs else (np.zeros(len(own)), np.zeros((len(own), 1)))
        false = model.false_rates if model.langs else np.zeros(1)
        coverage = model.coverage if model.langs else np.ones(1)
        shares = np.maximum(0, (hits / np.maximum(1, totals)[:, None] - false) / (1 - false)) / coverage
        for text, row in zip(own, shares):
            if not model.langs or not any(map(str.isalpha, text)):
                langs.append(UNKNOWN)
                scores.append(0.0)
            elif row.max() == 0:
                langs.append(model.common)
                scores.append(0.0)
            else:
                langs.append(model.langs[row.argmax()])
                scores.append(min(1.0, float(row.max())))
    return langs, scores


def identify(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row by its text alone; the model is broadcast.

    A null doc_id stays null, repeated rows each have their row, an empty table gives an empty
    result, and other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def convert(columns):
        langs, scores = classify(shared.value, columns[1])
        return {"doc_id": columns[0], "lang_pred": langs, "score": scores}

    chosen = required(docs, doc_id, text)
    ddl = "doc_id bigint, lang_pred string, score double"
    return map_batches(chosen.select(chosen[doc_id].cast("bigint"), chosen[text]), ddl, convert)


def known_language(docs: DataFrame, model: Model, min_score: float, *, text: str = "text") -> DataFrame:
    """The rows whose language can be told with at least ``min_score``, with all their columns.

    Null and empty texts, and those without a letter, go; repeated rows are judged alike; an empty
    table gives an empty result; columns of any name are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts):
        return [lang != UNKNOWN and score >= min_score for lang, score in zip(*classify(shared.value, texts))]

    return filter_batches(docs, text, keep)
