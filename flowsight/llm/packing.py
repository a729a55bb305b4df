"""Pack token ids into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from flowsight.llm.batches import arrow_schema, required, slices
from flowsight.llm.merges import MergeTable, merged_words
from flowsight.llm.words import IdMemo, Memo, Splitter, blocks, is_latin, only_loaded

WINDOW = 2048
END_ID = 1
# Windows that one differencing fills, and the longest piece of a document that takes part in it.
GROUP_WINDOWS = 128
PIECE = 256
# Ids that a window may stay short of its size, so that near-equal windows need not be equal.
SLACK = 8
# Words that a worker remembers, and rows and characters that it encodes at a time: the new words of all of them are merged
# together, which costs less the more they are.
WORDS = 250_000
ROWS = 5_000
CHARS = 24_000_000


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + place) for place, byte in enumerate(others)}


class WordTokens:
    """Ids of whole texts by a vocabulary with word ends, equal to the tokeniser's own.

    The vocabulary lower-cases, drops white space and cuts texts into pieces that it merges one by
    one. Where all code points are below 256, lower-casing and cutting are plain, and the merges of
    the pieces are replayed together. Other texts are cut at blanks, which tokens never cross, and
    parts with other code points go through the tokeniser itself. So do whole texts that hold one of the
    vocabulary's added tokens literally, which the tokeniser gives their own ids.
    """

    def __init__(self, path: str, words: int = WORDS):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            state = json.load(file)
        self.added = [token["content"] for token in state["added_tokens"]]
        vocabulary, suffix = state["model"]["vocab"], state["model"]["end_of_word_suffix"]
        first = state["pre_tokenizer"]["pretokenizers"][0]
        self.split = Splitter(first["pattern"]["Regex"])
        letters = byte_letters()
        self.single = np.array([vocabulary[letters[byte]] for byte in range(256)], np.int32)
        self.last = np.array([vocabulary[letters[byte] + suffix] for byte in range(256)], np.int32)
        merges = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in state["model"]["merges"]]
        pairs = np.array([(vocabulary[left], vocabulary[right]) for left, right in merges], np.int64)
        results = np.array([vocabulary[left + right] for left, right in merges], np.int32)
        self.table = MergeTable(pairs, np.arange(len(merges), dtype=np.int32), results)
        self.pieces = IdMemo(self.encode_pieces, limit=words)
        self.units = Memo(self.encode_units, limit=words * 2 // 5)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return merged_words([piece.encode() for piece in pieces], self.single, self.table, self.last)

    def encode_units(self, units: list[str]) -> list[bytes]:
        plain = [unit for unit in units if is_latin(unit)]
        packed = dict(zip(plain, self.pieces.packed(self.split(unit.lower()) for unit in plain)))
        others = [unit for unit in units if unit not in packed]
        for unit, encoded in zip(others, self.whole.encode_batch(others, add_special_tokens=False)):
            packed[unit] = array("I", encoded.ids).tobytes()
        return [packed[unit] for unit in units]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers."""
        for block in blocks(texts, CHARS):
            special = [place for place in block if any(token in texts[place] for token in self.added)]
            encoded = self.whole.encode_batch([texts[place] for place in special], add_special_tokens=False)
            done = {place: array("I", found.ids).tobytes() for place, found in zip(special, encoded)}
            plain = [place for place in block if place not in done and is_latin(texts[place])]
            done |= zip(plain, self.pieces.packed(self.split(texts[place].lower()) for place in plain))
            split = {place: texts[place].replace("\n", " ").split(" ") for place in block if place not in done}
            table = self.units.table(chain.from_iterable(split.values()))
            done |= {place: b"".join(map(table.__getitem__, units)) for place, units in split.items()}
            yield from (done[place] for place in block)


def word_tokens(path: str, words: int = WORDS) -> WordTokens:
    return only_loaded(WordTokens, path, words)


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece: Karmarkar-Karp differencing over ``windows`` sums.

    Each piece starts as a partial partition with one filled window. The two partial partitions with
    the largest spread are merged again and again, the fullest window of one with the emptiest of the
    other, until one is left.
    """
    heap = []
    for place, size in enumerate(sizes.tolist()):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, place, sums, np.array([place]), np.zeros(1, np.int64)))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, items, slots = heapq.heappop(heap)
        _, _, other, more, taken = heapq.heappop(heap)
        both = sums + other[::-1]
        order = np.argsort(-both, kind="stable")
        place = np.empty(windows, np.int64)
        place[order] = np.arange(windows)
        both = both[order]
        entry = (np.concatenate([items, more]), place[np.concatenate([slots, windows - 1 - taken])])
        heapq.heappush(heap, (int(both[-1] - both[0]), count, both, *entry))
        count += 1
    _, _, _, items, slots = heap[0]
    result = np.empty(len(sizes), np.int64)
    result[items] = slots
    return result


def near_equal_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of near-equal size, one more each time that a window would hold more than ``capacity``."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        placed = difference(sizes, windows)
        if np.bincount(placed, weights=sizes).max() <= capacity:
            return placed
        windows += 1


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "ids binary"
)


def cut(total: int, first: int, window: int, piece: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces from id ``first`` on: whole windows, then short pieces."""
    spans, start = [], first
    while total - start >= window:
        spans.append((start, window))
        start += window
    while start < total:
        spans.append((start, min(piece, total - start)))
        start += spans[-1][1]
    return spans


class Packer:
    """Puts the pieces of documents into windows as they come, and gives the windows numbers from ``base`` on.

    Pieces of a whole window are windows of their own. Shorter ones gather until they fill
    ``group`` windows but for ``slack`` ids each; these windows are then differenced and given out.
    """

    def __init__(self, base: int, window: int, group: int, piece: int, slack: int):
        self.next, self.window, self.piece, self.slack = base, window, piece, slack
        self.goal = group * max(1, window - slack)
        self.waiting: list[tuple] = []
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        start, total = 0, len(ids)
        for start, length in cut(total, 0, self.window, self.piece):
            if length == self.window:
                yield doc, ids, start, length, self.next, 0
                self.next += 1
                continue
            while self.held + length >= self.goal:
                part = self.goal - self.held
                self.hold(doc, ids, start, part)
                start, length = start + part, length - part
                yield from self.close()
            self.hold(doc, ids, start, length)

    def hold(self, doc, ids: np.ndarray, start: int, length: int) -> None:
        if length:
            self.waiting.append((doc, ids, start, length))
            self.held += length

    def close(self) -> Iterator[tuple]:
        """The waiting pieces with their window and place in it."""
        if not self.waiting:
            return
        sizes = np.array([piece[3] for piece in self.waiting], np.int64)
        placed = near_equal_windows(sizes, self.window)
        order = np.argsort(placed, kind="stable")
        used, window, offset = -1, -1, 0
        for place in order.tolist():
            if placed[place] != window:
                window, used, offset = placed[place], used + 1, 0
            yield *self.waiting[place], self.next + used, offset
            offset += int(sizes[place])
        self.next += used + 1
        self.waiting, self.held = [], 0

    def finish(self) -> Iterator[tuple]:
        """The last pieces: what does not fill windows goes to sequences whose lengths are powers of two."""
        whole = self.held // self.window
        rest = self.held - whole * max(1, self.window - self.slack) if whole else self.held
        tail: list[tuple] = []
        while rest:
            doc, ids, start, length = self.waiting.pop()
            part = min(rest, length)
            tail.append((doc, ids, start + length - part, part))
            if part < length:
                self.waiting.append((doc, ids, start, length - part))
            rest, self.held = rest - part, self.held - part
        yield from self.close()
        left = sum(piece[3] for piece in tail)
        room = offset = 0
        for doc, ids, start, length in tail:
            while length:
                if offset == room:
                    room, offset = min(self.window, 1 << left.bit_length() - 1), 0
                    self.next += 1
                part = min(length, room - offset)
                yield doc, ids, start, part, self.next - 1, offset
                start, length, offset, left = start + part, length - part, offset + part, left - part


def pack(
    docs: DataFrame,
    path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    group: int = GROUP_WINDOWS,
    piece: int = PIECE,
    slack: int = SLACK,
    keep_ids: bool = True,
    words: int = WORDS,
    rows_at_once: int = ROWS,
) -> DataFrame:
    """``PIECES`` of every row: which ids of a document are where in which sequence.

    Each task packs the rows that it reads, so nothing is shuffled, and only the pieces of one group
    of windows are held. A sequence's number begins with that of its partition: a task that runs
    again gives the same numbers. A sequence is meant to be padded to ``window`` unless its length is a
    power of two, so what is left at the end of a task is cut into such lengths. A null or empty text is one
    piece of the end id; a null doc_id stays null; repeated rows are packed again; an empty table gives an
    empty result; other columns are ignored. Without ``keep_ids`` the ids column is null. ``words`` and
    ``rows_at_once`` set what a worker holds against what it computes again; the result does not depend on them.
    """
    schema = arrow_schema(PIECES)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        bodies = [ids[start : start + length].tobytes() for _, ids, start, length, _, _ in rows]
        columns = [
            [row[0] for row in rows], [row[2] for row in rows], [row[3] for row in rows],
            [zlib.crc32(body) for body in bodies], [len(row[1]) for row in rows],
            [row[4] for row in rows], [row[5] for row in rows], bodies if keep_ids else [None] * len(rows),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path, words)
        packer = Packer(TaskContext.get().partitionId() << 32, window, group, piece, slack)
        end = END_ID.to_bytes(4, "little")
        rows: list[tuple] = []
        for batch in batches:
            for part in slices(batch, rows_at_once):
                texts = [value or "" for value in part.column(1).to_pylist()]
                for doc, packed in zip(part.column(0).to_pylist(), tokens.encode(texts)):
                    rows.extend(packer.add(doc, np.frombuffer(packed + end, "<u4")))
                    if len(rows) >= 4_096:
                        yield batch_of(rows)
                        rows = []
        rows.extend(packer.finish())
        if rows:
            yield batch_of(rows)

    chosen = required(docs, doc_id, text)
    return chosen.select(chosen[doc_id].cast("bigint"), chosen[text]).mapInArrow(run, PIECES)
