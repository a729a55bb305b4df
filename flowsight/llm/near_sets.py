"""Near copies by the Jaccard similarity of shingle sets: SimHash and then MinHash bands give candidates, whole sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsight.llm.batches import arrow_schema, map_batches, slices
from flowsight.llm.components import component_roots
from flowsight.llm.near_dup import fingerprint_links, fingerprint_of, shingle_hashes
from flowsight.llm.words import forget
from flowsight.session import written

WORDS = 5
LEAST = 0.8
# Bands and hashes of a band: a pair at similarity 0.8 shares a band with probability 1 - (1 - 0.8^5)^30 = 0.999993.
BANDS = 30
BAND_HASHES = 5
# Of 150 minima, a pair at similarity s has about 150 s in common. One that is at least 0.8 alike has so few less than
# 0.65 of them, 4.6 deviations off, with probability 0.000003.
SLACK = 0.15
# Nodes of an open band, and shingles of them, that are compared with as many others by one call.
BLOCK_NODES = 4_000
BLOCK_SHINGLES = 1_000_000
# Where an open band fills more blocks than one, its nodes are first compared with this many further hubs, one after another.
HUBS = 3
# Up to so many nodes (8 bytes each) go to all executors, where they pick the texts asked for; for more all texts are shuffled.
ASKED = 1_000_000
# Shingles that are hashed at a time.
BLOCK = 2_048
DRAWN = np.random.default_rng(42).integers(0, 1 << 64, size=(2, BANDS * BAND_HASHES), dtype=np.uint64)
MASKS, FACTORS = DRAWN[0], DRAWN[1] | np.uint64(1)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingle hashes of a whole text, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, size)]))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the drawn hash functions; the greatest number for an empty set."""
    least = np.full(BANDS * BAND_HASHES, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), BLOCK):
        drawn = (hashes[low : low + BLOCK, None] ^ MASKS) * FACTORS
        least = np.minimum(least, (drawn ^ (drawn >> np.uint64(32))).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """One key a band; a text without words has the keys of the empty set."""
    return [xxhash.xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(least.reshape(BANDS, -1))]


ADDED = ("place", "node", "print", "keys", "minima")


def added_names(df: DataFrame) -> dict[str, str]:
    """Names for the columns that ``signatures`` adds, which none of the table's own has."""
    taken = {name.lower() for name in df.columns}
    tail = ""
    while any(f"_{name}{tail}" in taken for name in ADDED):
        tail += "_"
    return {name: f"_{name}{tail}" for name in ADDED}


def signatures(docs: DataFrame, text: str, size: int) -> DataFrame:
    """All columns of every row; and a number of its own, a hash and the SimHash of its shingle set, band keys, and 16 bits of its minima."""
    names = added_names(docs)
    kinds = dict(zip(ADDED, (T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.ShortType()))))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(names[name], kind) for name, kind in kinds.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1_000):
                node, prints, keys, bits = [], [], [], []
                for value in part.column(part.schema.get_field_index(text)).to_pylist():
                    hashes = shingle_set(value, size)
                    least = minima(hashes)
                    node.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
                    prints.append(fingerprint_of([hashes]))
                    keys.append(band_keys(least))
                    bits.append(least.astype(np.uint16).view(np.int16))
                added = [
                    pa.array(np.arange(place, place + part.num_rows)), pa.array(node, pa.int64()), pa.array(prints, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int16())),
                ]
                place += part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *names.values()])

    return docs.mapInArrow(run, schema)


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The distinct pairs ``u, v`` of which the minima leave it possible that they are so alike, with the share in common."""
    left, right = (nodes.select(F.col("node").alias(side), F.col("minima").alias(f"of_{side}")) for side in "uv")
    same = F.reduce(
        F.zip_with("of_u", "of_v", lambda a, b: (a == b).cast("int")), F.lit(0), lambda total, one: total + one
    )
    share = (same / (BANDS * BAND_HASHES)).alias("share")
    both = pairs.select("u", "v").distinct().join(right, "v").join(left, "u").select("u", "v", share)
    return both.where(F.col("share") >= least - SLACK)


def shingle_sets(texts: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """``node, hashes`` of the nodes asked for, each set hashed once, as a written table."""

    def convert(columns):
        return {"node": columns[0], "hashes": [shingle_set(text, size).view(np.int64) for text in columns[1]]}

    asked = written(asked, "asked")
    if asked.count() <= ASKED:
        asked = F.broadcast(asked)
    # texts of one node have one set, so any of them will do
    found = texts.join(asked, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    return written(map_batches(found.select("node", "text"), "node bigint, hashes array<bigint>", convert), "sets")


def near_enough(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs ``u, v`` whose whole shingle sets have at least the similarity ``least``, as a written table.

    The sets of the nodes that are asked for are hashed once each, and then compared in the JVM.
    """
    pairs = written(pairs.select("u", "v"), "pairs")
    sets = shingle_sets(texts, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), size)
    left, right = (sets.select(F.col("node").alias(side), F.col("hashes").alias(f"of_{side}")) for side in "uv")
    common = F.size(F.array_intersect("of_u", "of_v"))
    alike = common >= least * (F.size("of_u") + F.size("of_v") - common)
    return written(pairs.join(right, "v").join(left, "u").where(alike).select("u", "v"), "links")


def with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are not yet in one component, with the roots of both."""
    for side in "uv":
        found = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(found, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.where("root_u <> root_v")


def of_other_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    return with_roots(pairs, roots).drop("root_u", "root_v")


def between_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Links of nodes as links of their components."""
    return with_roots(pairs, roots).select(F.col("root_u").alias("u"), F.col("root_v").alias("v")).distinct()


class Links:
    """The components that the links found so far make."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, size: int, least: float):
        self.texts, self.nodes, self.size, self.least = texts, nodes, size, least
        self.roots = nodes.select("node", F.col("node").alias("root")).limit(0)

    def try_pairs(self, pairs: DataFrame) -> None:
        """Compare the pairs that may be alike, each node with its likeliest partner first, then the others if still apart."""
        found = written(likely(of_other_roots(pairs, self.roots), self.nodes, self.least), "likely")
        if found.isEmpty():
            return
        best = found.groupBy("v").agg(F.max(F.struct("share", "u")).alias("best")).select(F.col("best.u").alias("u"), "v")
        self.add(best)
        rest = written(of_other_roots(found, self.roots).join(best, ["u", "v"], "left_anti"), "unlike-yet")
        if not rest.isEmpty():
            self.add(rest)

    def add(self, pairs: DataFrame) -> None:
        """Verify pairs and take in those that are links."""
        self.join(near_enough(pairs, self.texts, self.size, self.least))

    def join(self, more: DataFrame) -> None:
        """Take in links, a written table; they are joined between components and not between all their nodes again."""
        if more.isEmpty():
            return
        joined = component_roots(between_roots(more, self.roots))
        upper = joined.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        moved = self.roots.join(upper, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
        self.roots = written(moved.unionByName(joined), "roots")


def open_bands(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root`` of the bands that have nodes of several components."""
    rooted = keyed.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    ends = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return written(rooted.join(ends.where("low < high").select("key"), "key"), "open-bands")


def block_links(
    roots: np.ndarray, chunks: np.ndarray, minima: np.ndarray, flat: np.ndarray, edges: np.ndarray, least: float
) -> list[tuple[int, int]]:
    """Places of nodes to link, so that all that are alike and in one block are in one component.

    Nodes of one root, or joined by earlier links of the block, are not compared; nor, where there are two chunks, nodes
    of one chunk. The minima leave few pairs, of which the whole sets (``flat`` from edge to edge) are counted.
    """
    _, part = np.unique(roots, return_inverse=True)
    across = chunks.min() != chunks.max()
    columns = np.ascontiguousarray(minima.T)
    values, ids = np.unique(flat, return_inverse=True)
    sizes, marked, links = np.diff(edges), np.zeros(len(values) + 1, bool), []
    for u in range(len(roots) - 1):
        open_rows = part[u + 1 :] != part[u]
        if across:
            open_rows &= chunks[u + 1 :] != chunks[u]
        if not open_rows.any():
            continue
        same = (columns[:, u + 1 :] == columns[:, u : u + 1]).sum(axis=0, dtype=np.int16)
        others = np.flatnonzero(open_rows & (same / len(columns) >= least - SLACK)) + u + 1
        if not len(others):
            continue
        own = ids[edges[u] : edges[u + 1]]
        marked[own] = True
        common = np.array([np.count_nonzero(marked[ids[edges[v] : edges[v + 1]]]) for v in others.tolist()])
        marked[own] = False
        alike = others[common >= least * (sizes[u] + sizes[others] - common)]
        joined, first = np.unique(part[alike], return_index=True)
        links.extend((u, int(v)) for v in alike[first])
        part[np.isin(part, joined)] = part[u]
    return links


def chunk_counts(bands: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """``key, main, others, mains``: in how many chunks of about ``block`` nodes, and of bounded sets, a band is compared.

    A band that fills more than one has chunks of its own for its largest component, the root ``main``.
    """

    def filled(count: Column, size: Column) -> Column:
        return F.ceil(F.greatest(count / block, size / BLOCK_SHINGLES)).cast("int")

    sized = bands.join(sets.select("node", F.size("hashes").alias("size")), "node")
    parts = sized.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    whole = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "root", "size")).alias("main")
    )
    fits = filled(F.col("n"), F.col("size")) <= 1
    rest = filled(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size"))
    counts = whole.select(
        "key", F.when(~fits, F.col("main.root")).alias("main"), F.when(fits, 1).otherwise(rest).alias("others"),
        F.when(fits, 0).otherwise(filled(F.col("main.n"), F.col("main.size"))).alias("mains"),
    )
    return written(counts, "chunks")


def band_links(bands: DataFrame, chunks: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links ``u, v`` that join all nodes that are alike and share a band of ``key, node, root``, as a written table.

    ``sets`` has the ``minima`` and ``hashes`` of the nodes. Each chunk of a band meets itself and each other one in a block of
    its own, but for two of its largest component; a block gives at most one link a node: pairs are compared where they
    are, and are no rows of a table.
    """
    is_main = F.col("root").eqNullSafe(F.col("main"))
    place = F.xxhash64("node")
    own = F.when(is_main, F.col("others") + F.pmod(place, F.col("mains"))).otherwise(F.pmod(place, F.col("others"))).cast("int")
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    met = bands.join(chunks, "key").select("key", "node", "root", own.alias("chunk"), F.explode(F.sequence(F.lit(0), last)).alias("met"))
    dealt = met.select("key", F.least("chunk", "met").alias("low"), F.greatest("chunk", "met").alias("high"), "chunk", "node", "root")
    schema = arrow_schema("u bigint, v bigint")

    def compare(block: pa.Table) -> pa.Table:
        # so that the links do not depend on the order in which rows come
        block = block.sort_by("node").combine_chunks()
        node, root, chunk = (block.column(name).to_numpy() for name in ("node", "root", "chunk"))
        minima, hashes = (block.column(name).combine_chunks() for name in ("minima", "hashes"))
        least_of = minima.flatten().to_numpy().reshape(block.num_rows, -1)
        edges = np.concatenate([[0], np.cumsum(hashes.value_lengths().to_numpy())])
        links = block_links(root, chunk, least_of, hashes.flatten().to_numpy(), edges, least)
        return pa.Table.from_arrays([pa.array([node[pair[side]] for pair in links], pa.int64()) for side in (0, 1)], schema=schema)

    return written(dealt.join(sets, "node").groupBy("key", "low", "high").applyInArrow(compare, "u bigint, v bigint"), "links")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """``u, v``: each node with one node of its SimHash group, linked fingerprints as in operator 2: at most 3 bits apart."""
    prints = written(nodes.groupBy("print").agg(F.min("node").alias("hub")), "prints")
    roots = component_roots(fingerprint_links(prints.select(F.col("print").alias("fp"))))
    rooted = prints.join(roots, prints["print"] == roots["node"], "left").select("print", F.coalesce("root", "print").alias("top"))
    hubs = prints.select(F.col("print").alias("top"), F.col("hub").alias("u"))
    pairs = nodes.select("print", F.col("node").alias("v")).join(rooted, "print").join(hubs, "top")
    return pairs.where("u <> v").select("u", "v")


def set_components(rows: DataFrame, size: int, least: float, hubs: int = HUBS, block: int = BLOCK_NODES) -> DataFrame:
    """``node, root`` of every node of ``rows`` (``node, text, keys, minima``) that is not the root of its component.

    With a column ``print``, the groups that SimHash makes come first, each node compared with one of its group; the
    bands then find what is alike but more than 3 bits apart. Of the bands, first each node is compared with one node of
    each of its bands, the hub, which joins a ball of near copies with as many comparisons as it has nodes. In bands that
    then still hold nodes of different components all nodes are compared, so no pair of a band is left out: in blocks of
    ``block`` nodes, and where a band fills several, after the same with other hubs.
    """
    kinds = [name for name in ("print", "keys", "minima") if name in rows.columns]
    nodes = rows.groupBy("node").agg(*[F.first(name).alias(name) for name in kinds])
    nodes = written(nodes, "nodes")
    keyed = nodes.select(F.explode("keys").alias("key"), "node")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.min("node").alias("hub")).where("count > 1")
    keyed = written(keyed.join(shared, "key"), "bands")
    held = Links(rows.select("node", "text"), nodes.select("node", "minima"), size, least)
    if "print" in kinds:
        held.try_pairs(simhash_pairs(nodes))
    held.try_pairs(keyed.where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")))
    still = open_bands(keyed.where("count > 2").select("key", "node"), held.roots)
    if still.isEmpty():
        return held.roots
    sets = shingle_sets(held.texts, still.select("node").distinct(), size).join(held.nodes, "node")
    chunks = chunk_counts(still, sets, block)
    for turn in range(hubs):
        large = still.join(chunks.where("mains > 0").select("key"), "key")
        if large.isEmpty():
            break
        order = F.xxhash64("node", F.lit(turn))
        chosen = large.groupBy("key").agg(F.min(F.struct(order.alias("order"), "node", "root")).alias("hub"))
        pairs = large.join(chosen, "key").where("root <> hub.root")
        held.try_pairs(pairs.select(F.col("hub.node").alias("u"), F.col("node").alias("v")))
        still = open_bands(still.select("key", "node"), held.roots)
        chunks = chunk_counts(still, sets, block)
    held.join(band_links(still, chunks, sets, least))
    return held.roots


def order_of(doc_id: Column, text: Column, place: Column) -> Column:
    """Which row of a group stays: the least doc_id, rows without one last; then by the text, and one of equal rows."""
    return F.struct(doc_id.isNull(), doc_id, F.xxhash64(text), place)


def first_of_each(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, least: float = LEAST
) -> DataFrame:
    """The row with the least doc_id of each group of near copies, with all its columns.

    Texts whose sets of ``size``-word shingles have a Jaccard similarity of ``least`` or more are
    linked, and linked texts are a group. One row of each group stays, also where rows have no doc_id,
    the same one, or are repeated: the least doc_id, null last, then by a hash of the text. Texts
    without words, null ones included, have one set, as have texts that differ only in repeats, order
    and white space. An empty table gives an empty result; columns of any name are kept.
    """
    names = added_names(docs)
    whole = written(signatures(docs, text, size), "signatures")
    place, node = (whole[names[name]] for name in ("place", "node"))
    rows = whole.select(node.alias("node"), whole[text].alias("text"), *(whole[names[c]].alias(c) for c in ("print", "keys", "minima")))
    roots = set_components(rows, size, least)
    own = whole.select(place.alias("place"), node.alias("node"), order_of(whole[doc_id], whole[text], place).alias("order"))
    rooted = own.join(roots, "node", "left").select("place", "order", F.coalesce("root", "node").alias("root"))
    crowded = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.min("order").alias("first")).where("rows > 1")
    losers = rooted.join(crowded, "root").where("order <> first").select(F.col("place").alias("loser"))
    losers = written(losers, "losers")
    return whole.join(losers, place == losers["loser"], "left_anti").select(*(whole[name] for name in docs.columns))
