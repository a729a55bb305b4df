"""SimHash near-duplicates by one-wildcard segment variants, and the groups that the links make."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import map_batches, required
from flowsight.llm.components import component_roots
from flowsight.session import written

SEED = 42
MAX_BITS = 3
BLOCK = 1 << 16
# Right rows that one left row may be compared with before a key is cut finer.
CROWD = 1_000


def shingle_hashes(text: str | None, size: int = 3):
    """Blocks of XXH64 values of the shingles of a whole text, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends[:-1]]
    last = ends[size - 1 :] or [len(joined) + 1]
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(last), BLOCK):
        spans = zip(starts[low : low + BLOCK], last[low : low + BLOCK])
        yield np.array([digest(joined[start : end - 1], SEED) for start, end in spans], dtype=np.uint64)


def fingerprint_of(blocks: Iterable[np.ndarray]) -> int:
    """64 bits, each 1 if over half of the hashes have it; no hash gives 0."""
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for hashes in blocks:
        total += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > total, bitorder="little") if total else np.zeros(8, dtype=np.uint8)
    return int(packed.view(np.int64)[0])


def fingerprint(text: str | None, size: int = 3) -> int:
    """The fingerprint of a whole text's shingles, repeats included; no word gives 0."""
    return fingerprint_of(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""

    def convert(columns):
        ids, texts = columns
        return {"doc_id": ids, "fp": [fingerprint(value) for value in texts]}

    chosen = required(docs, doc_id, text)
    return map_batches(chosen.select(chosen[doc_id].cast("bigint"), chosen[text]), "doc_id bigint, fp bigint", convert)


def segment(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def first_keys(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index over both 32-bit segments.

    Two fingerprints at most 3 bits apart have a segment in which they differ by one bit at most.
    A left row stands for its own segment and for each variant with a wildcard at a clear bit; the
    wildcard is written as a set bit, so it meets exactly the right rows that differ there or
    nowhere. ``start, width`` name the bits that the key leaves open.
    """
    fp, left, right = F.col("fp"), [], []
    for start in (0, 32):
        own = segment(fp, start, 32)
        own = own + F.lit(start // 32 << 32).cast("bigint")
        bits = [F.lit(1 << j).cast("bigint") for j in range(32)]
        keys = F.array_compact(F.array(own, *(F.when(own.bitwiseAND(bit) == 0, own + bit) for bit in bits)))
        rest = F.lit(32 - start).alias("start")
        left.append(distinct.select(F.explode(keys).alias("key"), "fp", rest))
        right.append(distinct.select(own.alias("key"), "fp", rest))
    return left[0].unionByName(left[1]), right[0].unionByName(right[1])


def finer_keys(rows: DataFrame, width: int, variants: bool) -> DataFrame:
    """Keys over the halves of the ``width`` bits that are still open; at most 3 differ there, so one half at most by one bit."""
    half, parts = width // 2, []
    for upper in (0, 1):
        place = F.col("start") + upper * half
        mask = F.lit((1 << half) - 1).cast("bigint")
        own = F.call_function("shiftrightunsigned", F.col("fp"), place).bitwiseAND(mask)
        values = F.array(own)
        if variants:
            values = F.concat(values, *(F.array(own.bitwiseXOR(F.lit(1 << j).cast("bigint"))) for j in range(half)))
        parts.append(
            rows.select("key", "fp", (F.col("start") + (1 - upper) * half).alias("start"), F.explode(values).alias("value")).select(
                F.xxhash64("key", F.lit(upper), "value").alias("key"), "fp", "start"
            )
        )
    return parts[0].unionByName(parts[1])


def verified(left: DataFrame, right: DataFrame) -> DataFrame:
    """Links among rows of equal keys, each compared on all 64 bits.

    The keys were exploded, of which the optimizer knows nothing: it takes 33 rows a fingerprint for one, and would
    broadcast them all. So both sides are sorted, whatever their estimated size.
    """
    pairs = left.select("key", F.col("fp").alias("u")).hint("merge").join(right.select("key", F.col("fp").alias("v")), "key")
    return pairs.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS)).select("u", "v")


def fingerprint_links(distinct: DataFrame, *, crowd: int = CROWD) -> DataFrame:
    """All pairs ``u, v`` of distinct fingerprints at most 3 bits apart (some more than once).

    A key with more than ``crowd`` right rows is not joined but cut finer over the bits it leaves
    open: 32, then 16, then 8, where no more than 256 fingerprints can be left. So a left row meets
    a bounded number of right rows however dense a ball of near copies is.
    """
    left, right = first_keys(distinct)
    found, width = [], 32
    while True:
        crowded = written(right.groupBy("key").count().where(F.col("count") > crowd).select("key"), "crowded")
        if width <= 8 or crowded.isEmpty():
            found.append(verified(left, right))
            break
        found.append(verified(left.join(crowded, "key", "left_anti"), right.join(crowded, "key", "left_anti")))
        left = finer_keys(left.join(crowded, "key", "left_semi"), width, True)
        right = finer_keys(right.join(crowded, "key", "left_semi"), width, False)
        width //= 2
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Rows of one fingerprint are one node, so copies make no links among themselves. A null or
    wordless text has fingerprint zero and is linked like any other; a row without a doc_id takes
    part, and a component of only such rows has a null component_id. Repeated rows stay repeated;
    an empty table gives an empty result; other columns are ignored.
    """
    rows = written(fingerprints(docs, doc_id=doc_id, text=text), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = component_roots(fingerprint_links(nodes.select("fp"), crowd=crowd))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(members, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of their component, with all their columns.

    Rows without a doc_id stay, since none of them can be named as the one to keep.
    """
    groups = near_duplicates(docs, doc_id=doc_id, text=text)
    repeats = written(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "repeats")
    return docs.join(repeats, docs[doc_id] == repeats["doc_id"], "left_anti")
