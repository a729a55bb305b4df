"""Quality of texts by the labels of their nearest neighbours among labelled latent-semantic vectors."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import arrow_schema, map_batches, required, slices
from flowsight.llm.words import blocks
from flowsight.session import written

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x1000003)
BLOCK_CHARS = 500_000


@dataclass(frozen=True)
class Settings:
    """``per_label``: labelled texts of each label that are kept as neighbours, a fixed bound whatever the
    number of labels; a label's votes are weighed so that its kept texts stand for all of them.
    ``n``: characters of a feature. ``slots``: features of each of the two kinds. ``bins``: steps of a share of repeats.
    ``kinds``: weights of letters, shapes and repeats. ``width``: dimensions of the latent space. ``nearest``: neighbours
    that vote, more where several are equally near. ``sharpness``: power of the similarity by which a vote counts.
    ``threshold``: the score from which a text is predicted to be good."""

    per_label: int = 1_500
    n: int = 4
    slots: int = 2_048
    bins: int = 8
    kinds: tuple[float, float, float] = (0.5, 1.0, 1.0)
    width: int = 48
    nearest: int = 15
    sharpness: int = 8
    threshold: float = 0.3

    @property
    def parts(self) -> list[tuple[slice, float]]:
        """The columns of each kind of features, and its weight."""
        ends = np.cumsum([0, self.slots, self.slots, 2 * self.bins]).tolist()
        return [(slice(low, high), weight) for low, high, weight in zip(ends, ends[1:], self.kinds)]

    @property
    def features(self) -> int:
        return 2 * self.slots + 2 * self.bins


@cache
def shapes() -> np.ndarray:
    """The shape of every code point: one for small, capital and other letters, for digits and for blanks; others are their own."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LM":
            table[code] = ord("A") if kind in ("Lu", "Lt") else ord("a") if kind == "Ll" else ord("b")
        elif kind[0] == "N":
            table[code] = ord("0")
        elif kind[0] == "Z":
            table[code] = ord(" ")
    return table


def codes_of(pieces: list[str]) -> np.ndarray:
    return np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces_of(text: str, n: int) -> list[str]:
    """A text in parts that share n - 1 characters, so that each n-gram is in one of them."""
    return [text[low : low + BLOCK_CHARS + n - 1] for low in range(0, max(1, len(text)), BLOCK_CHARS)]


def slot_counts(codes: np.ndarray, piece: np.ndarray, owner: np.ndarray, texts: int, n: int, slots: int) -> np.ndarray:
    """How many n-grams of each text fall into each slot; those over the edge of two pieces do not count."""
    spans = len(codes) - n + 1
    if spans < 1:
        return np.zeros((texts, slots), np.int64)
    keys = np.zeros(spans, np.uint64)
    for step in range(n):
        keys = keys * BASE + codes[step : step + spans].astype(np.uint64)
    keys = (keys ^ (keys >> np.uint64(29))) * MIX
    place = owner[piece[:spans]] * slots + ((keys ^ (keys >> np.uint64(32))) % np.uint64(slots)).astype(np.int64)
    return np.bincount(place[piece[:spans] == piece[n - 1 :]], minlength=texts * slots).reshape(texts, slots)


def spread_out(share: float, bins: int) -> np.ndarray:
    """A share from 0 to 1 as weights of the two nearest of ``bins`` steps."""
    row = np.zeros(bins)
    low = min(bins - 2, int(share * (bins - 1)))
    row[low + 1] = share * (bins - 1) - low
    row[low] = 1 - row[low + 1]
    return row


def repeats(text: str, bins: int) -> np.ndarray:
    """Of the words of a text: the share of repeated pairs, and of words that equal the one before."""
    words = text.split()
    if not words:
        return np.zeros(2 * bins)
    pairs, last = len(words) - 1, max(1, len(words) - 1)
    again = (pairs - len(set(zip(words, words[1:])))) / last
    doubled = sum(map(str.__eq__, words, words[1:])) / last
    return np.concatenate([spread_out(again, bins), spread_out(doubled, bins)])


def raw_features(texts: list[str], settings: Settings) -> np.ndarray:
    """A row for each whole text: log counts of n-grams of its letters and of its shapes, and its repeats.

    A text is lower-cased for the letters. A text without a word has no features.
    """
    rows = np.zeros((len(texts), settings.features), np.float32)
    padded = [f" {text} " if text.strip() else "" for text in texts]
    for (columns, _), change in zip(settings.parts, (str.lower, str)):
        split = [pieces_of(change(text), settings.n) for text in padded]
        owner = np.repeat(np.arange(len(texts)), [len(own) for own in split])
        flat = [piece for own in split for piece in own]
        codes = codes_of(flat)
        piece = np.repeat(np.arange(len(flat)), [len(part) for part in flat])
        counted = codes if change is str.lower else shapes()[codes]
        rows[:, columns] = np.log1p(slot_counts(counted, piece, owner, len(texts), settings.n, settings.slots))
    rows[:, settings.parts[2][0]] = [repeats(text, settings.bins) for text in texts]
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(1e-9, np.linalg.norm(rows, axis=-1, keepdims=True))


def weighed(raw: np.ndarray, idf: np.ndarray, settings: Settings) -> np.ndarray:
    """Features weighed by their rareness, each kind brought to its length."""
    rows = np.empty_like(raw)
    for columns, weight in settings.parts:
        rows[:, columns] = weight * unit(raw[:, columns] * idf[columns])
    return rows


def latent_axes(rows: np.ndarray, width: int) -> np.ndarray:
    """The leading right singular vectors of the rows, by subspace iteration from a fixed start."""
    width = min(width, *rows.shape)
    axes = np.random.default_rng(42).standard_normal((rows.shape[1], min(width + 16, *rows.shape))).astype(np.float32)
    for _ in range(5):
        axes, _ = np.linalg.qr(rows.T @ (rows @ axes))
    _, _, turned = np.linalg.svd(rows @ axes, full_matrices=False)
    return np.ascontiguousarray((axes @ turned.T)[:, :width])


@dataclass(frozen=True)
class Model:
    """``axes`` takes weighed features to the latent space; ``vectors`` has a unit row for each labelled text, with its label
    from 0 to 1 and the weight of its vote. At most 2 x ``per_label`` rows, so a few MB."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    settings: Settings


def document_frequencies(texts: DataFrame, settings: Settings) -> np.ndarray:
    """How many of all rows of ``text`` have each feature, and at last the number of rows."""
    schema = arrow_schema("slot int, docs bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(settings.features + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                own = [value or "" for value in part.column(0).to_pylist()]
                for block in blocks(own, BLOCK_CHARS):
                    rows = raw_features([own[place] for place in block], settings)
                    sums[:-1] += (rows > 0).sum(axis=0)
                    sums[-1] += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], schema=schema)

    counted = texts.select("text").mapInArrow(run, "slot int, docs bigint").groupBy("slot").agg(F.sum("docs").alias("docs"))
    found = counted.toArrow()
    sums = np.zeros(settings.features + 1, np.int64)
    sums[found["slot"].to_numpy()] = found["docs"].to_numpy()
    return sums


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[bool, int]]:
    """``doc_id, label`` of at most ``per_label`` documents of each label, those of least hash, and how many each label has."""
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    rated = rated.groupBy("doc_id").agg(F.avg(F.col("label").cast("double")).alias("label"))
    rated = written(rated.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    good = F.col("label") >= 0.5
    sizes = {row["good"]: row["count"] for row in rated.groupBy(good.alias("good")).count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [rated.where(which).orderBy(*order).limit(settings.per_label) for which in (good, ~good)]
    return written(chosen[0].unionByName(chosen[1]), "labelled-sample"), sizes


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, doc_id: str = "doc_id", text: str = "text",
    label: str = "label",
) -> Model:
    """Learn from the documents that ``labels`` (``doc_id, label`` with labels from 0 to 1) names.

    The rareness of features is counted over all documents. The latent space and the neighbours come
    from the bounded sample of ``labelled_sample``, whose features are what the driver gathers (49 MB
    at most by default). Several labels of a document are averaged, and of several texts of one
    doc_id the first by order counts; null ids, null labels and labels without a document are left out.
    """
    docs = required(docs, doc_id, text).toDF("doc_id", "text")
    labels = required(labels, doc_id, label).toDF("doc_id", "label")
    sums = document_frequencies(docs, settings)
    idf = np.log(1 + sums[-1] / (1 + sums[:-1])).astype(np.float32)
    sample, sizes = labelled_sample(docs, labels, settings)
    texts = docs.join(sample, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def convert(columns):
        ids, marks, own = columns
        rows = [raw_features([value or ""], settings)[0].tobytes() for value in own]
        return {"doc_id": ids, "label": marks, "raw": rows}

    found = map_batches(
        texts.select(F.col("doc_id").cast("bigint"), "label", "text"), "doc_id bigint, label double, raw binary", convert
    ).toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    marks = found["label"].to_numpy()[order].astype(np.float32)
    raw = np.zeros((len(order), settings.features), np.float32)
    for place, number in enumerate(order.tolist()):
        raw[place] = np.frombuffer(found["raw"][number].as_buffer(), np.float32)
    if not len(raw):
        nothing = np.zeros((0, 0), np.float32)
        return Model(idf, nothing, nothing, marks, marks, settings)
    rows = weighed(raw, idf, settings)
    axes = latent_axes(rows, settings.width)
    good = marks >= 0.5
    kept = {which: max(1, int((good == which).sum())) for which in (False, True)}
    weights = np.where(good, sizes.get(True, 0) / kept[True], sizes.get(False, 0) / kept[False]).astype(np.float32)
    return Model(idf, axes, unit(rows @ axes), marks, weights, settings)


def scores(model: Model, texts: list[str | None]) -> list[float]:
    """The weighed share of good labels among each text's nearest labelled neighbours.

    All cosines are computed, in blocks of texts; a vote counts by its similarity, and those as near as the
    last of the nearest ones vote too. A text that is null, empty or like no labelled text has the
    score 0, as has every text if nothing was learned.
    """
    texts = [text or "" for text in texts]
    if not len(model.vectors):
        return [0.0] * len(texts)
    found: list[float] = []
    nearest = min(model.settings.nearest, len(model.vectors))
    for block in blocks(texts, BLOCK_CHARS):
        raw = raw_features([texts[place] for place in block], model.settings)
        latent = unit(weighed(raw, model.idf, model.settings) @ model.axes)
        # rounded, so that equally near texts stay so whatever the block they are compared in
        cosine = np.round(latent @ model.vectors.T, 5).clip(0, 1)
        last = np.partition(cosine, -nearest, axis=1)[:, -nearest, None]
        votes = np.where(cosine >= last, cosine**model.settings.sharpness * model.weights, 0).astype(np.float64)
        share = votes @ model.labels / np.maximum(1e-30, votes.sum(axis=1))
        found += np.round(share, 6).clip(0, 1).tolist()
    return found


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row by its text alone; the model is broadcast, at a bounded size.

    A null doc_id stays null, repeated rows each have their row, an empty table gives an empty
    result, and other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def convert(columns):
        found = scores(shared.value, columns[1])
        return {"doc_id": columns[0], "score": found, "predicted": [int(x >= shared.value.settings.threshold) for x in found]}

    chosen = required(docs, doc_id, text)
    ddl = "doc_id bigint, score double, predicted int"
    return map_batches(chosen.select(chosen[doc_id].cast("bigint"), chosen[text]), ddl, convert)
