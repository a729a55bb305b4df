"""Quality rules: counts over words and lines, and bands of tokeniser fertility."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsight.llm.batches import arrow_schema, required, slices
from flowsight.llm.bpe import read_ranks
from flowsight.llm.words import Memo, blocks, only_loaded
from flowsight.session import written

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


# Of a measure, what lies further than this many times the distance of its quartiles outside them is rejected.
FENCE = 4.0
# Texts that a band must be measured on.
BAND_TEXTS = 100
# The measures of each vocabulary, and what the distance to the fence is at least.
SHAPES = {"chars_per_token": 0.2, "fallback_share": 0.05, "token_entropy": 0.4}
VOCABULARIES = ("piece", "byte")
SHAPE_NAMES = tuple(f"{vocabulary}_{shape}" for vocabulary in VOCABULARIES for shape in SHAPES)


@dataclass(frozen=True)
class Vocabularies:
    """Places of a SentencePiece vocabulary with byte fallback, and of the ranks and pattern of a byte-level one."""

    pieces: str
    ranks: str
    pattern: str


# First and last code points of the letters that stand for a script.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "han": ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}


class WordShapes:
    """Ids of single words by both vocabularies, kept by the worker; and which ids stand for bytes of a character."""

    def __init__(self, files: Vocabularies):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        ranks = read_ranks(files.ranks)
        self.bytes = tiktoken.Encoding("bytes", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        piece_bytes = np.array([self.pieces.is_byte(number) for number in range(self.pieces.get_piece_size())])
        part_of_character = np.zeros(max(ranks.values()) + 1, bool)
        part_of_character[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80]] = True
        self.fallback = (piece_bytes, part_of_character)
        self.memo = Memo(self.encode, limit=100_000)

    def encode(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """A word is encoded by itself, by the byte-level vocabulary as after a blank."""
        texts = [word.decode() for word in words]
        pieces = self.pieces.encode(texts, num_threads=1)
        return [
            (array("i", ids).tobytes(), array("i", self.bytes.encode_ordinary(f" {text}")).tobytes())
            for ids, text in zip(pieces, texts)
        ]


def word_shapes(files: Vocabularies) -> WordShapes:
    return only_loaded(WordShapes, files)


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in windows of five words that the text holds more than once."""
    spans = len(words) - WINDOW + 1
    if spans < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(spans, np.uint64)
    for step in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[step : step + spans]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    suspects = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    places = defaultdict(list)
    for place in suspects.tolist():
        places[tuple(words[place : place + WINDOW])].append(place)
    starts = np.array([place for found in places.values() if len(found) > 1 for place in found], dtype=np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(body: bytes) -> int:
    lines = [line for line in body.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


@cache
def script_table() -> np.ndarray:
    """The number of the script of every code point, 0 for other characters."""
    table = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            table[low : high + 1] = number
    return table


def script_of(text: str) -> str:
    """The script with the most letters; ``other`` where none of the known ones has a letter."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(script_table()[codes], minlength=len(SCRIPTS) + 1)[1:]
    return list(SCRIPTS)[counts.argmax()] if counts.any() else "other"


def fertility(ids: np.ndarray, chars: int, byte_ids: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, share of fallback bytes, and token entropy in bits; zeros without a token."""
    if not len(ids):
        return 0.0, 0.0, 0.0
    ordered = np.sort(ids)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    shares = np.diff(edges) / len(ids)
    return chars / len(ids), float(byte_ids[ids].mean()), abs(float((shares * np.log2(shares)).sum()))


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "script string, n_tokens bigint, " + ", ".join(f"{name} double" for name in SHAPE_NAMES)
)
MEASURE_NAMES = tuple(field.split()[0] for field in MEASURES.split(","))


def measure(texts: list[str | None], files: Vocabularies) -> list[tuple]:
    """The values of ``MEASURES`` for whole texts; a null text is an empty one."""
    texts = [text or "" for text in texts]
    words_of = word_shapes(files)
    rows = []
    for block in blocks(texts, 2_000_000):
        bodies = [texts[place].encode() for place in block]
        split = [body.split() for body in bodies]
        table = words_of.memo.table(chain.from_iterable(split))
        for place, body, words in zip(block, bodies, split):
            chars = len(texts[place]) - len(body) + sum(map(len, words))
            repeat = repeated_words(words)
            failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
            packed = list(zip(*map(table.__getitem__, words))) or [(), ()]
            ids = [np.frombuffer(b"".join(own), np.int32) for own in packed]
            shapes = [value for own, bytes_of in zip(ids, words_of.fallback) for value in fertility(own, chars, bytes_of)]
            symbols = len(body) - len(body.translate(None, SYMBOLS))
            rows.append((
                len(words), chars, symbols, duplicate_lines(body), repeat, failed, script_of(texts[place]), len(ids[0]), *shapes,
            ))
    return rows


def measured(docs: DataFrame, files: Vocabularies, text: str) -> DataFrame:
    """All columns of every row with those of ``MEASURES``, in one pass without a shuffle."""
    added = arrow_schema(MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1_000):
                rows = measure(part.column(part.schema.get_field_index(text)).to_pylist(), files)
                columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), added)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *added.names])

    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(MEASURES).fields])
    return docs.mapInArrow(run, schema)


def bands(rows: DataFrame, group: Column, least: int = BAND_TEXTS) -> DataFrame:
    """``kind, size`` and the ``low_`` and ``high_`` ends of each measure, from all texts that pass the base rules.

    Texts of one group are compared with those of about their number of tokens (a power of two), as all
    measures vary more in short ones. An end lies ``FENCE`` times the distance of the quartiles
    outside them. Sizes of a group with fewer than ``least`` texts have no band.
    """
    sound = rows.where(~F.col("base_failed")).select(group.alias("kind"), size_class().alias("size"), *SHAPE_NAMES)
    quartiles = [F.percentile_approx(name, [0.25, 0.75], 10_000).alias(name) for name in SHAPE_NAMES]
    found = sound.groupBy("kind", "size").agg(F.count(F.lit(1)).alias("texts"), *quartiles).where(F.col("texts") >= least)
    ends = []
    for name in SHAPE_NAMES:
        low, high = F.col(name)[0], F.col(name)[1]
        reach = F.greatest(FENCE * (high - low), F.lit(SHAPES[name.split("_", 1)[1]]))
        ends += [(low - reach).alias(f"low_{name}"), (high + reach).alias(f"high_{name}")]
    return found.select("kind", "size", "texts", *ends)


def size_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def kind_of(rows: DataFrame, lang: str | None) -> Column:
    """The stated language, or the script where none is stated."""
    script = F.concat(F.lit("script "), F.col("script"))
    return script if lang is None or lang not in rows.columns else F.coalesce(rows[lang], script)


def judged(rows: DataFrame, lang: str | None) -> DataFrame:
    """``rows``, a written table of measures, with ``outside``, the measures out of their band, and ``kept``."""
    kind = kind_of(rows, lang)
    found = written(bands(rows, kind), "bands")
    joined = rows.join(found.drop("texts"), (kind == found["kind"]) & (size_class() == found["size"]), "left")
    out = [
        F.when((F.col(name) < F.col(f"low_{name}")) | (F.col(name) > F.col(f"high_{name}")), F.lit(name))
        for name in SHAPE_NAMES
    ]
    named = joined.withColumn("outside", F.concat_ws(",", *out))
    return named.withColumn("kept", ~F.col("base_failed") & (F.col("outside") == "")).select(*rows.columns, "outside", "kept")


def quality(
    docs: DataFrame, files: Vocabularies, *, doc_id: str = "doc_id", text: str = "text", lang: str | None = "lang"
) -> DataFrame:
    """``doc_id``, ``MEASURES``, ``outside`` and ``kept`` of every row.

    Texts are split into words at ASCII white space, and each word is encoded by itself by the two
    vocabularies. Characters per token, the share of tokens that are bytes of a character, and the
    entropy of the tokens are measured for both. Texts that pass the base rules set the bands of their
    stated language, or of their script where ``lang`` is null or not a column, and what is far outside
    a band is not kept (``bands``). The measures are written to the shared folder, so texts are encoded once.

    A null, empty or wordless text has zeros and fails; a null doc_id stays null; repeated rows each
    have their row and count in the bands; an empty table gives an empty result; other columns are ignored.
    """
    chosen = required(docs, doc_id, text)
    if lang is not None and lang in docs.columns:
        chosen = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang"))
    else:
        chosen, lang = chosen.select(chosen[doc_id].cast("bigint").alias("doc_id"), chosen[text].alias("text")), None
    rows = written(measured(chosen, files, "text").drop("text"), "measures")
    return judged(rows, lang and "lang").select("doc_id", *MEASURE_NAMES, "outside", "kept")


def good_rows(
    docs: DataFrame, files: Vocabularies, *, text: str = "text", lang: str | None = "lang"
) -> DataFrame:
    """The rows whose text is kept, as ``quality`` has it, with all their columns.

    Nulls, repeated rows and empty tables are as there; columns of any name are kept.
    """
    names = [f"c{place}" for place in range(len(docs.columns))]
    place = {name: new for name, new in zip(docs.columns, names)}
    rows = written(measured(docs.toDF(*names), files, place[text]), "measures")
    return judged(rows, place.get(lang)).where("kept").select(*[rows[new].alias(name) for name, new in place.items()])
