"""Operators over result lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.functions.results import extract


def result_columns(lines: DataFrame) -> DataFrame:
    """Result lines with their extracted columns; the VARIANT itself is dropped."""
    return extract(lines).drop("v")


def outcome_counts(lines: DataFrame) -> DataFrame:
    """One row: ``results``, ``errors`` and lines that are ``neither``."""
    return extract(lines).agg(
        F.count_if("is_result").alias("results"),
        F.count_if("is_error").alias("errors"),
        F.count_if(~F.col("is_result") & ~F.col("is_error")).alias("neither"),
    )


def structured(lines: DataFrame, schema: str) -> DataFrame:
    """Content text parsed as JSON into ``data`` typed by ``schema`` (a DDL string).

    Content that does not parse keeps its row: ``data`` is NULL and ``bad_content`` is true.
    """
    typed = f"{schema}, _corrupt string"
    parsed = extract(lines).withColumn(
        "_parsed",
        F.from_json("content", typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}),
    )
    bad = F.col("content").isNull() | F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    return (
        parsed.withColumn("bad_content", bad)
        .withColumn("data", F.when(~bad, F.col("_parsed").dropFields("_corrupt")))
        .drop("_parsed", "v")
    )
