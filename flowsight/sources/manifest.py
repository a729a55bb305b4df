"""File manifests: sizes and digests of the files of a folder, and one digest for all of them.

The listing of a folder names every file; the digests are made by the tasks. Files up to
``WHOLE_BYTES`` are read by ``binaryFile``, one row a file. Larger ones are read in pieces by one task
each, with a fixed amount of memory, through Arrow's file systems (local paths and those of
Hadoop, S3 and Google); a digest is sequential, so more tasks could not share one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.session import written

WHOLE_BYTES = 256 << 20
PIECE_BYTES = 8 << 20
SCHEME = "^[a-z0-9]+:/*"
# Leaves of the hash tree of a folder, and how many of them a node has below it, as hexadecimal digits of the name's hash.
LEAF_DIGITS = 4
FAN_DIGITS = 2


def digests_in_pieces(large: DataFrame) -> DataFrame:
    """``path, bytes, md5, sha256`` of the files at ``path``, read piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                md5, sha256, size = hashlib.md5(), hashlib.sha256(), 0
                with system.open_input_stream(place) as stream:
                    while piece := stream.read(PIECE_BYTES):
                        md5.update(piece)
                        sha256.update(piece)
                        size += len(piece)
                row = {"path": [path], "bytes": [size], "md5": [md5.hexdigest()], "sha256": [sha256.hexdigest()]}
                yield pa.RecordBatch.from_pydict(row)

    return large.select("path").mapInArrow(run, "path string, bytes bigint, md5 string, sha256 string")


def file_manifest(
    spark: SparkSession, path: str, *, pattern: str | None = None, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """``name, bytes, md5, sha256`` for each file below ``path`` (or for that file), empty ones and those of any size included."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    # of a small file the content, of others only the listing is read
    small = files.where(F.col("length") <= whole_bytes).select(
        "path", F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256")
    )
    listed = written(files.select("path", "length"), "listed-files")
    large = listed.where(F.col("length") > whole_bytes)
    found = small.unionByName(digests_in_pieces(large.repartition(max(1, large.count()), "path")))
    # the reader passes over empty files, which the listing still names
    names = spark.createDataFrame([(name,) for name in files.inputFiles()], "path string")
    nothing = [F.lit(0).cast("bigint").alias("bytes"), F.lit(hashlib.md5().hexdigest()).alias("md5"), F.lit(hashlib.sha256().hexdigest()).alias("sha256")]
    # those names are addresses, with escapes
    decoded = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    empty = names.select(without_scheme(decoded).alias("path")).join(
        listed.select(without_scheme(F.col("path")).alias("path")), "path", "left_anti"
    ).select("path", *nothing)
    both = found.withColumn("path", without_scheme(F.col("path"))).unionByName(empty)
    folder = re.sub(SCHEME, "/", path.rstrip("/")) + "/"
    inside = F.when(F.contains("path", F.lit(folder)), F.substring_index("path", folder, -1))
    return both.select(inside.otherwise(F.substring_index("path", "/", -1)).alias("name"), "bytes", "md5", "sha256")


def without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, SCHEME, "/")


def audit_manifest(manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Status per file against ``expected(name, bytes, md5)``.

    ``missing``, ``size_differs``, ``digest_differs``, ``unexpected`` or ``verified``.
    """
    actual, wanted = manifest.alias("a"), expected.alias("e")
    status = (
        F.when(F.col("a.name").isNull(), "missing")
        .when(F.col("e.name").isNull(), "unexpected")
        .when(F.col("a.bytes") != F.col("e.bytes"), "size_differs")
        .when(F.col("a.md5") != F.lower("e.md5"), "digest_differs")
        .otherwise("verified")
    )
    return actual.join(wanted, F.col("a.name") == F.col("e.name"), "full_outer").select(
        F.coalesce("a.name", "e.name").alias("name"), "a.bytes", "a.md5", "a.sha256", status.alias("status")
    )


def require_verified(audit: DataFrame) -> None:
    bad = audit.where(~F.col("status").isin("verified", "unexpected")).orderBy("name").collect()
    if bad:
        raise ValueError("source files: " + ", ".join(f"{row.name} {row.status}" for row in bad))


def nodes_above(nodes: DataFrame) -> DataFrame:
    """The parents of tree nodes: the digest of the prefixes and digests of a node's children in order."""
    children = F.array_sort(F.collect_list(F.struct("prefix", "digest"))).alias("children")
    parent = F.substring("prefix", 1, F.length("prefix") - FAN_DIGITS)
    grouped = nodes.groupBy(parent.alias("parent")).agg(children, F.sum("files").alias("files"))
    return grouped.select(F.col("parent").alias("prefix"), F.sha2(F.to_json("children"), 256).alias("digest"), "files")


def hash_tree(manifest: DataFrame) -> DataFrame:
    """``prefix, digest, files``: a tree of digests over the files of a manifest; the root has the empty prefix.

    A leaf stands for the files whose names hash to its prefix, and its digest is made of their names and
    digests in name order, so a task holds one leaf's files or one node's 256 children, and never all names. A
    changed file changes its leaf and the nodes above it, and no other.
    """
    leaf = F.substring(F.sha2("name", 256), 1, LEAF_DIGITS)
    files = F.array_sort(F.collect_list(F.struct("name", "sha256"))).alias("children")
    nodes = manifest.groupBy(leaf.alias("prefix")).agg(files, F.count(F.lit(1)).alias("files")).select(
        "prefix", F.sha2(F.to_json("children"), 256).alias("digest"), "files"
    )
    levels = [written(nodes, "hash-leaves")]
    for _ in range(LEAF_DIGITS // FAN_DIGITS):
        levels.append(nodes_above(levels[-1]))
    tree = levels[0]
    for level in levels[1:]:
        tree = tree.unionByName(level)
    return tree


def changed_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """``prefix`` of the leaves in which two trees differ; only their files need to be looked at again."""
    old, new = (tree.where(F.length("prefix") == LEAF_DIGITS).select("prefix", "digest") for tree in (before, after))
    both = old.withColumnRenamed("digest", "old").join(new.withColumnRenamed("digest", "new"), "prefix", "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("prefix")


def folder_digest(spark: SparkSession, path: str) -> str:
    """One SHA-256 for a folder: the root of the hash tree over its files."""
    root = hash_tree(file_manifest(spark, path)).where(F.col("prefix") == "").first()
    if root is None:
        raise ValueError(f"no files in {path}")
    return root.digest
