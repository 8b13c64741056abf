"""Checks of request lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import has, is_blank, parse_lines

# The findings, in the order one line reports them.
NOT_READABLE = "Could not read line"
NOT_JSON = "Invalid JSON"
REQUIRED = ["custom_id", "method", "url", "body"]
MISSING = "Missing required field: "


def _findings(v: str) -> Column:
    """The messages of one line. A field counts as there whatever its value, null included."""
    absent = [F.when(~has(v, name), MISSING + name) for name in REQUIRED]
    absent.append(F.when(has(v, "body") & ~has(v, "body", "model"), MISSING + "body.model"))
    return (
        F.when(~F.is_valid_utf8("raw"), F.array(F.lit(NOT_READABLE)))
        .when(F.col(v).isNull(), F.array(F.lit(NOT_JSON)))
        .otherwise(F.array_compact(F.array(*absent)))
    )


def _checked(lines: DataFrame) -> DataFrame:
    parsed = parse_lines(lines.drop("v").where(~is_blank("raw")), trim=True)
    return parsed.withColumn("_found", _findings("v"))


def validation_errors(lines: DataFrame) -> DataFrame:
    """One row per finding: the line's columns, ``rule`` (position in the line) and ``message``.

    Order by ``file, line, rule`` for the report; the rows themselves are not shuffled.
    """
    keep = [c for c in lines.columns if c not in ("raw", "v")]
    return _checked(lines).select(*keep, F.posexplode("_found").alias("rule", "message"))


def file_verdicts(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per file ``errors`` and ``valid``. ``files`` adds files that have no line at all."""
    counts = _checked(lines).groupBy("file").agg(F.sum(F.size("_found")).cast("bigint").alias("errors"))
    if files is not None:
        counts = files.select("file").join(counts, "file", "left").fillna(0, ["errors"])
    return counts.withColumn("valid", F.col("errors") == 0)
