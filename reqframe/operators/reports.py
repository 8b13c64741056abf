"""Reports as text: one compact JSON object per row, or tab-separated values without a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.money import cost_text
from reqframe.operators.stats import measured

# Fixed value: what a plain report shows for a missing value.
NOTHING = "-"


def _with_cost_text(df: DataFrame) -> DataFrame:
    """Costs as reports carry them: decimal text, not numbers."""
    money = [name for name, kind in df.dtypes if kind == "decimal(38,15)"]
    return df.withColumns({name: cost_text(name) for name in money}) if money else df


def _or_nothing(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(NOTHING))


# The columns of each plain report, in order.
PLAIN: dict[str, list[str | Column]] = {
    "batches": ["id", "status"],
    "files": ["id", "filename", "bytes"],
    "models": ["alias"],
    "stats": ["lines", "estimated_input_tokens", "parse_errors"],
    "diff": ["common", "identical", "different", "only_in_a", "only_in_b"],
    "usage": ["total_request_count", "total_input_tokens", "total_output_tokens", "total_cost"],
}


def plain_analytics(with_id: bool) -> list[str | Column]:
    """Columns of the analytics report; the batch id leads when several batches are shown."""
    return (["batch_id"] if with_id else []) + [
        "total_requests",
        "total_tokens",
        F.coalesce("avg_duration_ms", F.lit(0.0)),
        F.coalesce(F.col("total_cost"), F.lit("0")),
    ]


def plain_requests() -> list[str | Column]:
    return [
        "timestamp",
        _or_nothing("model"),
        _or_nothing("status_code"),
        _or_nothing("total_tokens"),
        _or_nothing(F.concat(F.col("duration_ms").cast("string"), F.lit("ms"))),
    ]


def as_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One compact JSON object per row, missing values as null."""
    fields = F.struct(*(columns or df.columns))
    return _with_cost_text(df).select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def as_plain(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Tab-separated text without a header."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return _with_cost_text(df).select(F.concat_ws("\t", *[p.cast("string") for p in parts]).alias("value"))


def analytics_json(analytics: DataFrame) -> DataFrame:
    """``{batch_id, analytics}`` lines, so that each row of several batches tells its own."""
    inner = [c for c in analytics.columns if c not in ("batch_id", "ordinal")]
    text = _with_cost_text(analytics)
    return as_json(text.select("batch_id", F.struct(*inner).alias("analytics")))


def stats_json(lines: DataFrame) -> DataFrame:
    """Request statistics of a set as JSON: ``lines, models`` (requests by model), ``estimated_input_tokens, parse_errors``.

    Lines are reduced to one row a model before they become one object.
    """
    per_model = measured(lines).groupBy("model").agg(
        F.count("*").alias("n"), F.count_if("_bad").alias("bad"), F.sum("_bytes").alias("bytes")
    )
    named = F.collect_list(F.when(F.col("model").isNotNull(), F.struct("model", "n")))
    whole = per_model.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        F.map_from_entries(F.array_sort(named)).alias("models"),
        F.expr("coalesce(sum(bytes) div 4, 0)").alias("estimated_input_tokens"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("parse_errors"),
    )
    return as_json(whole)


def diff_json(summary: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """The comparison of two named sets as JSON; a side's warnings appear only if it has any."""
    columns = [
        F.lit(file_a).alias("file_a"),
        F.lit(file_b).alias("file_b"),
        "entries_a",
        "entries_b",
        "common",
        F.col("identical").alias("identical_responses"),
        F.col("different").alias("different_responses"),
        "only_in_a",
        "only_in_b",
    ]
    kinds = ("parse_errors", "missing_id", "duplicates")
    for side in ("a", "b"):
        found = [F.col(f"{kind}_{side}") for kind in kinds]
        warnings = F.struct(*[c.alias(kind) for c, kind in zip(found, kinds)])
        columns.append(F.when(sum(found[1:], found[0]) > 0, warnings).alias(f"warnings_{side}"))
    return summary.select(F.to_json(F.struct(*columns)).alias("value"))


def write_report(report: DataFrame, path: str) -> None:
    """Write a report's text column."""
    report.write.text(path, lineSep="\n")
