"""Batch readers. Every schema is given, none is inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsight.contract import FLOW, FLOW_EVENT_SCHEMA, RUN_TRUTH_SCHEMA, RawLayout


def with_file_name(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.withColumn(column, F.col("_metadata.file_name"))


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType = FLOW.schema) -> DataFrame:
    """CSV whose header must name the schema's columns in the same order.

    The header of the first file is compared here; ``enforceSchema=false`` makes Spark compare
    the header of every file it parses. A token that does not fit its type fails the read.
    """
    options = {"header": True, "mode": "FAILFAST"}
    header = spark.read.options(**options).csv(path).columns
    if header != schema.fieldNames():
        raise ValueError(f"unexpected header in {path}: {header}")
    return spark.read.schema(schema).options(enforceSchema=False, **options).csv(path)


def read_csv_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_raw_text(spark: SparkSession, paths: str | Sequence[str], layout: RawLayout) -> DataFrame:
    """Headerless CSV with every token kept as text, plus the name of its file."""
    reader = spark.read.schema(layout.schema).options(header=False, mode="FAILFAST")
    return with_file_name(reader.csv(paths if isinstance(paths, str) else list(paths)))


def read_raw_files(spark: SparkSession, root: str, names: Sequence[str], layout: RawLayout) -> DataFrame:
    """One scan over the named files of a folder; files that are not there are named in the error."""
    listing = spark.read.format("binaryFile").load(root).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    present = {row.name for row in listing.where(F.col("name").isin(*names)).collect()}
    absent = [name for name in names if name not in present]
    if absent:
        raise FileNotFoundError(f"missing source files: {', '.join(absent)}")
    return read_raw_text(spark, [f"{root}/{name}" for name in names], layout)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_parquet(spark: SparkSession, path: str, *, nested: bool = False) -> DataFrame:
    """``nested`` reads every folder below ``path``."""
    return spark.read.option("recursiveFileLookup", nested).parquet(path)


def read_events(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = FLOW_EVENT_SCHEMA) -> DataFrame:
    """JSON lines of one or several folders."""
    return spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def read_run_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_TRUTH_SCHEMA).json(path)
