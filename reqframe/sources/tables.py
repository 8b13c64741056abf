"""Tables that requests are built from, and blobs that requests refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.session import plan_bytes
from reqframe.sources.lines import index_rows


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table, or a CSV with a header line (its columns are text unless typed)."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True).option("multiLine", False).option("escape", '"')
        return (reader.schema(schema) if schema else reader).csv(path)
    return spark.read.parquet(path)


# A table below this size, the default one of a row group, may sit in one row group, which only one task can read.
_SPREAD_BELOW = 128 << 20


def spread(table: DataFrame, key: str) -> DataFrame:
    """Hand a small table to all cores before per-row JSON work; large tables are left alone.

    The shuffle is bounded by the size checked here, but comes once for every use of the table. A larger
    one has several row groups, and more of them as it grows.
    """
    if plan_bytes(table) >= _SPREAD_BELOW:
        return table
    return table.repartition(table.sparkSession.sparkContext.defaultParallelism, key)


def indexed_table(table: DataFrame) -> DataFrame:
    """A table read from files with its row numbers in file order: ``line, pos, seq`` and more."""
    located = table.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return index_rows(located)


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """``(path, bytes)`` of the files below a directory, paths without their scheme."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.regexp_replace("path", "^file:(//)?", "").alias("path"), F.col("content").alias("bytes")
    )
