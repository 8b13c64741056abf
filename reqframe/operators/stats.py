"""Request-set statistics and cost estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import items_at, kind, member, parsed, text_at
from reqframe.functions.money import COST, PRICE, cost

# Fixed value: bytes of prompt text that count as one token.
BYTES_PER_TOKEN = 4


def _content_bytes(message: Column) -> Column:
    """Bytes of a message's text: the string content, or every string ``text`` of its parts."""
    content = member(message, "content")

    def part_bytes(total: Column, part: Column) -> Column:
        return total + F.coalesce(F.octet_length(text_at(part, "text")), F.lit(0))

    return F.when(
        kind(content) == "STRING", F.octet_length(F.try_variant_get(content, "$", "string")).cast("bigint")
    ).otherwise(
        F.aggregate(
            F.coalesce(
                F.try_variant_get(content, "$", "array<variant>"),
                F.expr("cast(array() as array<variant>)"),
            ),
            F.lit(0).cast("bigint"),
            part_bytes,
        )
    )


def prompt_bytes(v: str = "v") -> Column:
    """UTF-8 bytes of all message texts of a request; 0 when it has none."""
    messages = F.coalesce(items_at(v, "body", "messages"), F.expr("cast(array() as array<variant>)"))
    return F.aggregate(
        messages,
        F.lit(0).cast("bigint"),
        lambda total, m: total + F.coalesce(_content_bytes(m), F.lit(0)),
    )


def _tokens(column: str) -> Column:
    """Whole tokens of all bytes together: sum first, divide once."""
    return F.expr(f"sum({column}) div {BYTES_PER_TOKEN}")


def measured(lines: DataFrame, *keep: str) -> DataFrame:
    """What statistics need of each line: ``_bad``, ``model``, ``_bytes`` of its prompt, ``_max`` tokens."""
    return parsed(lines).select(
        *keep,
        F.col("v").isNull().alias("_bad"),
        text_at("v", "body", "model").alias("model"),
        prompt_bytes().alias("_bytes"),
        F.coalesce(F.try_variant_get("v", "$.body.max_tokens", "bigint"), F.lit(0)).alias("_max"),
    )


def request_stats(lines: DataFrame, *by: str) -> DataFrame:
    """``lines`` (unparsable ones included), ``parse_errors``, ``estimated_input_tokens``.

    One row, or one for each value of the ``by`` columns (such as ``file``). Bytes are summed
    over all lines and divided once.
    """
    return measured(lines, *by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("_bad").alias("parse_errors"),
        F.coalesce(_tokens("_bytes"), F.lit(0)).alias("estimated_input_tokens"),
    )


def requests_per_model(lines: DataFrame) -> DataFrame:
    """``model, requests`` sorted by model; only string models count."""
    model = text_at("v", "body", "model").alias("model")
    counts = parsed(lines).select(model).where(F.col("model").isNotNull()).groupBy("model")
    return counts.agg(F.count(F.lit(1)).alias("requests")).orderBy("model")


def cost_by_model(lines: DataFrame, prices: DataFrame, window: str = "24h") -> DataFrame:
    """Estimated tokens and cost per model for one completion window.

    Requests are reduced to one row per model before the price lookup, so neither a frequent
    model nor the price table's size matters. An unknown model keeps a NULL cost.
    """
    per_model = (
        measured(lines)
        .where(F.col("model").isNotNull())
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            _tokens("_bytes").alias("estimated_input_tokens"),
            F.sum("_max").alias("estimated_output_tokens"),
        )
    )
    asked = prices.where(F.col("completion_window") == window).select(
        "model", F.col("input_price").cast(PRICE), F.col("output_price").cast(PRICE)
    )
    return per_model.join(asked, "model", "left").select(
        "model",
        "request_count",
        "estimated_input_tokens",
        "estimated_output_tokens",
        cost(
            F.col("estimated_input_tokens"),
            F.col("estimated_output_tokens"),
            F.col("input_price"),
            F.col("output_price"),
        ).alias("estimated_cost"),
    )


def cost_totals(by_model: DataFrame) -> DataFrame:
    """The totals row of :func:`cost_by_model`; models without a price add no cost."""
    return by_model.agg(
        F.coalesce(F.sum("request_count"), F.lit(0)).alias("total_requests"),
        F.coalesce(F.sum("estimated_input_tokens"), F.lit(0)).alias("total_estimated_input_tokens"),
        F.coalesce(F.sum("estimated_output_tokens"), F.lit(0)).alias("total_estimated_output_tokens"),
        F.coalesce(F.sum("estimated_cost"), F.lit(0)).cast(COST).alias("total_estimated_cost"),
    )
