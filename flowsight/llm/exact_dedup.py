"""Exact duplicates through a minimal perfect hash over the digests of a history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import required, text_or_empty
from flowsight.session import written

WHITE = " \t\n\x0b\x0c\r"
DIGEST_BYTES = 32
# Slots of a level per key that is not placed yet.
LOAD = 2
SHARD_KEYS = 20_000
LOOKUP_ROWS = 50_000


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def text_digests(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, chars, digest``: code points of the text, SHA-256 of the text without white space."""
    chosen = required(docs, doc_id, text)
    body = text_or_empty(chosen, text)
    return chosen.select(
        chosen[doc_id].alias("doc_id"),
        F.char_length(body).alias("chars"),
        F.unhex(F.sha2(normalised(body).cast("binary"), 256)).alias("digest"),
    )


def winners(digests: DataFrame) -> DataFrame:
    """``digest, keep_id, chars, group_size``: the longest original text wins, then the least doc_id.

    Rows of a digest are combined before the shuffle, so a text with very many copies costs one row a task.
    """
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("minus")))
    return digests.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", (-F.col("best.minus")).alias("keep_id"), F.col("best.chars").alias("chars"), "group_size"
    )


def words_of(digests: np.ndarray) -> np.ndarray:
    return digests.reshape(-1, DIGEST_BYTES).view("<u8")


def level_slots(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Slots of digests at a level; another mix of their words at each."""
    odd = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1)
    mixed = (words[:, level % 4] ^ (words[:, (level + 1) % 4] >> np.uint64(level % 31 + 1))) * odd
    return ((mixed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit levels of a minimal perfect hash over distinct digests, and the order of the digests in its slots.

    A digest that is alone in its slot of a level is placed there, the others go on to the next.
    """
    levels, order, open_rows, words = [], [], np.arange(len(digests)), words_of(digests)
    while len(open_rows):
        if len(levels) == 256:
            raise ValueError("the digests of a shard are not distinct")
        slots = level_slots(words[open_rows], len(levels), LOAD * len(open_rows) + 1)
        alone = np.bincount(slots, minlength=LOAD * len(open_rows) + 1) == 1
        placed = alone[slots]
        order.append(open_rows[placed][np.argsort(slots[placed])])
        levels.append(alone)
        open_rows = open_rows[~placed]
    return levels, np.concatenate(order) if order else np.arange(0)


def find(digests: np.ndarray, levels: list[np.ndarray], held: np.ndarray) -> np.ndarray:
    """Slot of each digest, or -1: the digest held in the slot is compared byte by byte."""
    found = np.full(len(digests), -1, dtype=np.int64)
    waiting, base, words = np.arange(len(digests)), 0, words_of(digests)
    for number, bits in enumerate(levels):
        slots = level_slots(words[waiting], number, len(bits))
        hit = bits[slots]
        ranks = np.cumsum(bits) - 1
        found[waiting[hit]] = base + ranks[slots[hit]]
        base += int(bits.sum())
        waiting = waiting[~hit]
    member = found >= 0
    same = (held.reshape(-1, DIGEST_BYTES)[found[member]] == digests.reshape(-1, DIGEST_BYTES)[member]).all(axis=1)
    found[np.flatnonzero(member)[~same]] = -1
    return found


def stacked(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, DIGEST_BYTES)


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


INDEX = "shard int, sizes binary, levels binary, digests binary, keep_id binary, chars binary, group_size binary"


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row a shard: the bit levels, and by slot the full digest with the winner's locator."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.reset_index(drop=True)
        levels, order = build_hash(stacked(part["digest"]))
        ordered = part.loc[order]
        numbers = {
            name: [ordered[name].fillna(np.iinfo(np.int64).min).to_numpy(np.int64).tobytes()]
            for name in ("keep_id", "chars", "group_size")
        }
        return pd.DataFrame(
            {
                "shard": [part["shard"].iloc[0]],
                "sizes": [np.array([len(bits) for bits in levels], np.int64).tobytes()],
                "levels": [b"".join(np.packbits(bits).tobytes() for bits in levels)],
                "digests": [b"".join(ordered["digest"])],
                **numbers,
            }
        )

    return history.withColumn("shard", shard_of(F.col("digest"), shards)).groupBy("shard").applyInPandas(build, INDEX)


def read_levels(sizes: bytes, packed: bytes) -> list[np.ndarray]:
    levels, start = [], 0
    for size in np.frombuffer(sizes, np.int64):
        end = start + (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(packed[start:end], np.uint8))[:size].astype(bool))
        start = end
    return levels


FOUND = "doc_id bigint, row_chars bigint, digest binary, keep_id bigint, chars bigint, group_size bigint"


def look_up(digests: DataFrame, index: DataFrame, shards: int, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Every row of ``digests`` with what the index holds for it (``group_size`` null: not a member).

    A shard that many rows ask for, because one text has very many copies, is read by several
    tasks: its rows are dealt over as many salts as they need, and its index row is repeated for each.
    """
    asked = digests.withColumn("shard", shard_of(F.col("digest"), shards))
    salts = written(
        asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / lookup_rows).cast("int").alias("salts")), "salts"
    )
    salted = asked.join(salts, "shard").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "chars"), F.col("salts").cast("bigint")).cast("int")
    )
    copies = index.join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))

    def answer(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"doc_id": rows["doc_id"], "row_chars": rows["chars"], "digest": rows["digest"]})
        if rows.empty or held.empty:
            return out.assign(keep_id=None, chars=None, group_size=None)
        shard = held.iloc[0]
        found = find(stacked(rows["digest"]), read_levels(shard["sizes"], shard["levels"]), np.frombuffer(shard["digests"], np.uint8))
        for name in ("keep_id", "chars", "group_size"):
            values = np.frombuffer(shard[name], np.int64)[np.maximum(found, 0)]
            out[name] = pd.Series(values, index=out.index).where((found >= 0) & (values != np.iinfo(np.int64).min)).astype("Int64")
        return out

    keys = ["shard", "salt"]
    return salted.groupBy(keys).cogroup(copies.drop("salts").groupBy(keys)).applyInPandas(answer, FOUND)


def looked_up(digests: DataFrame, history: DataFrame, shard_keys: int = SHARD_KEYS, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Every row of ``digests`` with what an index of ``history`` holds for it."""
    known = written(history, "history")
    shards = max(1, -(-known.count() // shard_keys))
    return look_up(digests, build_index(known, shards), shards, lookup_rows)


def exact_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    history: DataFrame | None = None,
    shard_keys: int = SHARD_KEYS,
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    ``history`` has the rows of ``winners`` from earlier loads; its winners are never replaced, and
    ``group_size`` counts its rows too. Without it the digests of ``docs`` themselves are the history.
    Digests that the index does not hold are grouped among themselves. A null text counts as empty;
    rows without a doc_id count, and win only where no copy as long has one. Repeated rows are all
    returned, with the same answer; an empty table gives an empty result; other columns are ignored.
    """
    digests = written(text_digests(docs, doc_id=doc_id, text=text), "digests")
    found = looked_up(digests, winners(digests) if history is None else history, shard_keys, lookup_rows)
    if history is not None:
        found = written(found, "found")
        fresh = winners(
            found.where("group_size is null").select("doc_id", F.col("row_chars").alias("chars"), "digest")
        )
        more = winners_more(found)
        strangers = found.where("group_size is null").select("doc_id", "digest").join(
            fresh.select("digest", "keep_id", "group_size"), "digest"
        )
        members = found.where("group_size is not null").join(more, "digest").select(
            "digest", "doc_id", "keep_id", (F.col("group_size") + F.col("seen")).alias("group_size")
        )
        found = members.unionByName(strangers)
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def winners_more(found: DataFrame) -> DataFrame:
    """How many rows of this load each historical digest has."""
    return found.where("group_size is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("seen"))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one that ``exact_duplicates`` keeps.

    A row is known by its doc_id together with its text, so one id of several texts, and rows without
    an id, lose no text and keep no copy. Of rows that are equal in both, the one with the least hash of its
    text stays. Null and empty texts are equal to each other; an empty table gives an empty result;
    columns of any name are kept.
    """
    digests = written(text_digests(docs, doc_id=doc_id, text=text), "digests")
    found = written(looked_up(digests, winners(digests)).where("group_size > 1"), "copies")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_chars") == F.col("chars"))

    def key(own_id: Column, digest: Column, chars: Column) -> list[Column]:
        # small, so that more of them can be broadcast: 32 bits tell the texts of one id apart, rows without an id need more
        values = digest, chars.cast("bigint")
        return [own_id, F.hash(*values), F.when(own_id.isNull(), F.xxhash64(*values)).otherwise(F.lit(0))]

    names = ("own_id", "of_id", "of_text")
    losing = key(F.col("doc_id"), F.col("digest"), F.col("row_chars"))
    losers = found.where(~wins).select(*[column.alias(name) for name, column in zip(names, losing)]).distinct()
    losers = written(losers, "losers")
    repeated = written(found.where(wins).groupBy("digest").count().where("count > 1").select(F.col("digest").alias("again")), "repeated")
    body = text_or_empty(docs, text)
    digest = F.unhex(F.sha2(normalised(body).cast("binary"), 256))
    same = [column.eqNullSafe(losers[name]) for name, column in zip(names, key(docs[doc_id], digest, F.char_length(body)))]
    kept = docs.join(losers, same, "left_anti")
    if repeated.isEmpty():
        return kept
    same_text = digest == repeated["again"]
    # rows of a group are combined before the shuffle
    first = F.min_by(F.struct(*[docs[name] for name in docs.columns]), F.xxhash64(docs[text])).alias("first")
    once = kept.join(repeated, same_text, "inner").groupBy(repeated["again"]).agg(first).select("first.*")
    return kept.join(repeated, same_text, "left_anti").unionByName(once)
