"""Byte-level BPE by merge replay: texts to ids and ids back to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import required, slices
from flowsight.llm.merges import MergeTable, merge_words
from flowsight.llm.words import Memo, Splitter, blocks, only_loaded

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteTokens:
    """Ids of texts by ranks and a splitting pattern, as a tokeniser without special tokens gives them."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.split = Splitter(pattern)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([byte])] for byte in range(256)], np.int32)
        pairs = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.table = MergeTable(table[:, :2], table[:, 2], table[:, 2])
        self.memo = Memo(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of matches of the pattern; a match that is a token itself is that token."""
        words = [piece.encode() for piece in pieces]
        whole = [self.ranks.get(word) for word in words]
        merged = iter(merge_words([word for word, rank in zip(words, whole) if rank is None], self.single, self.table))
        return [next(merged) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers."""
        for block in blocks(texts):
            split = [self.split(texts[place]) for place in block]
            table = self.memo.table(chain.from_iterable(split))
            for pieces in split:
                yield b"".join(map(table.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def byte_tokens(path: str, pattern: str) -> ByteTokens:
    return only_loaded(ByteTokens, path, pattern)


def id_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encoded(docs: DataFrame, path: str, pattern: str, doc_id: str, text: str, with_body: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(path, pattern)
        for batch in batches:
            for part in slices(batch):
                packed = list(tokens.encode([value or "" for value in part.column(1).to_pylist()]))
                columns = {"doc_id": part.column(0), "ids": id_lists(packed)}
                if with_body:
                    columns["body"] = pa.array([tokens.decode(np.frombuffer(ids, np.int32)) for ids in packed], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    chosen = required(docs, doc_id, text)
    ddl = "doc_id bigint, ids array<int>" + ", body binary" * with_body
    return chosen.select(chosen[doc_id].cast("bigint"), chosen[text]).mapInArrow(run, ddl)


def encode(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row, whole texts without special tokens.

    The corpus is taken in blocks: the distinct matches of the pattern in a block that the worker does
    not remember are merged together through one index of pairs. A null text counts as empty and has
    no ids; a null doc_id stays null; repeated rows each have their row; an empty table gives an empty
    result; other columns are ignored.
    """
    return encoded(docs, path, pattern, doc_id, text, False)


def encode_and_decode(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, body``: ``encode`` and ``decode`` in one pass, with one worker a task."""
    return encoded(docs, path, pattern, doc_id, text, True)


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, body``: the bytes that the ids stand for; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(path, pattern)
        for batch in batches:
            lists = batch.column(1)
            bodies = [tokens.decode(row.values.to_numpy(zero_copy_only=False)) if row.is_valid else b"" for row in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(bodies, pa.binary())], names=["doc_id", "ids", "body"]
            )

    return required(ids, "doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, body binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the rows of ``decode``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("body", 256).alias("decoded_sha256"),
    )
