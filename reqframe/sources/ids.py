"""Lists of ids given as arguments, a file, or both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import WHITE_SPACE
from reqframe.sources.literal import literal_rows
from reqframe.sources.lines import index_lines, scan_lines


def read_ids(
    spark: SparkSession, ids: Sequence[str] = (), from_file: str | None = None
) -> DataFrame:
    """``(ordinal, id)``: arguments first, then the non-blank lines of the file or folder, trimmed.

    Order and repeats are kept. No id at all is an error.
    """
    given = literal_rows(spark, list(enumerate(ids)), "ordinal bigint, id string")
    if from_file is None:
        if not ids:
            raise ValueError("no ids: pass ids or a file of them")
        return given
    lines = index_lines(scan_lines(spark, from_file)).select(
        (F.col("seq") + len(ids)).alias("ordinal"),
        F.btrim("raw", F.lit(WHITE_SPACE)).alias("id"),
    )
    if not ids and lines.isEmpty():
        raise ValueError(f"no ids in {from_file}")
    return given.unionAll(lines)
