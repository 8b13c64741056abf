"""Expressions over result lines: content, token usage, outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import _col, computed_once, items_at, kind, member, parsed, text_at

# The two places a result line may keep its response body.
FLAT = ("response_body",)
NESTED = ("response", "body")

# Batch states.
TERMINAL = ["completed", "failed", "cancelled", "expired"]
ACTIVE = ["in_progress", "validating"]


def truthy(x: Column) -> Column:
    """Whether a VARIANT counts as set: present and not null, false, 0, "", [] or {}."""
    shape = kind(x)
    return (
        F.when(x.isNull() | (shape == "VOID"), False)
        .when(shape == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(shape == "STRING", F.try_variant_get(x, "$", "string") != "")
        .when(shape.startswith("ARRAY"), F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        .when(shape.startswith("OBJECT"), shape != "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != 0, F.lit(True)))
    )


def response_body(v: Column | str, nested_only: bool = False) -> Column:
    """The response body as a VARIANT: the flat member where it is set, else the nested one."""
    nested = member(v, *NESTED)
    if nested_only:
        return nested
    flat = member(v, *FLAT)
    return F.when(truthy(flat), flat).otherwise(nested)


def answer(body: Column | str) -> Column:
    """The first choice's content as a VARIANT of any type, NULL when absent."""
    return member(body, "choices", 0, "message", "content")


def canonical(content: Column) -> Column:
    """Content as comparable text: strings as they are, other JSON compact, absent as ``""``."""
    return (
        F.when(content.isNull(), F.lit(""))
        .when(kind(content) == "STRING", F.try_variant_get(content, "$", "string"))
        .otherwise(F.to_json(content))
    )


def with_content(lines: DataFrame, nested_only: bool = False) -> DataFrame:
    """Add ``custom_id`` (JSON strings only) and canonical ``content``."""
    return (
        parsed(lines)
        .withColumn("_answer", answer(response_body("v", nested_only)))
        .withColumns({"custom_id": text_at("v", "custom_id"), "content": canonical(F.col("_answer"))})
        .drop("_answer")
    )


def extract(lines: DataFrame) -> DataFrame:
    """Add the result columns to lines, and ``v``.

    ``content`` is NULL when absent, ``content_kind`` its JSON type. ``is_result``: some choice exists. ``is_error``: none does
    and ``error`` is set. Both are false for a line that is neither.
    """
    staged = (
        computed_once(parsed(lines), "_body", response_body("v"))
        .withColumn("_answer", answer("_body"))
        .withColumn("is_result", F.coalesce(F.size(items_at("_body", "choices")) > 0, F.lit(False)))
    )

    def tokens(name: str) -> Column:
        return F.try_variant_get("_body", f"$.usage.{name}", "bigint")

    return staged.withColumns(
        {
            "custom_id": text_at("v", "custom_id"),
            "content": F.when(F.col("_answer").isNotNull(), canonical(F.col("_answer"))),
            "content_kind": kind(F.col("_answer")),
            "prompt_tokens": tokens("prompt_tokens"),
            "completion_tokens": tokens("completion_tokens"),
            "total_tokens": tokens("total_tokens"),
            "is_error": ~F.col("is_result") & truthy(member("v", "error")),
        }
    ).drop("_answer", "_body")


def is_terminal(status: Column | str) -> Column:
    return _col(status).isin(TERMINAL)


def is_active(status: Column | str) -> Column:
    return _col(status).isin(ACTIVE)
