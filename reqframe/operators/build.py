"""Request lines built from tables and from earlier results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import computed_once
from reqframe.functions.results import extract

# The request envelope.
METHOD = "POST"
CHAT_URL = "/v1/chat/completions"
EMBEDDINGS_URL = "/v1/embeddings"


def numbered(prefix: str, width: int, number: Column | str) -> Column:
    """An id such as ``request-0007``."""
    return F.format_string(f"{prefix}%0{width}d", number)


def _line(custom_id: Column, url: str, body: Column) -> Column:
    return F.to_json(
        F.struct(
            custom_id.alias("custom_id"),
            F.lit(METHOD).alias("method"),
            F.lit(url).alias("url"),
            body.alias("body"),
        )
    )


def chat_line(
    custom_id: Column,
    user: Column,
    model: Column | None = None,
    system: Column | None = None,
    max_tokens: Column | int | None = None,
    response_format: str | None = None,
) -> Column:
    """The JSON text of a chat request. Parts that are None or NULL are left out."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = [message("user", user)]
    if system is not None:
        messages.insert(0, message("system", system))
    fields = [F.array(*messages).alias("messages")]
    if model is not None:
        fields.insert(0, model.alias("model"))
    if max_tokens is not None:
        limit = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
        fields.append(limit.alias("max_tokens"))
    if response_format is not None:
        fields.append(F.struct(F.lit(response_format).alias("type")).alias("response_format"))
    return _line(custom_id, CHAT_URL, F.struct(*fields))


def embedding_line(custom_id: Column, text: Column, model: Column) -> Column:
    body = F.struct(model.alias("model"), text.alias("input"))
    return _line(custom_id, EMBEDDINGS_URL, body)


def build_requests(table: DataFrame, *keep: str, **parts) -> DataFrame:
    """``raw`` chat lines from a table's rows, next to the ``keep`` columns."""
    return computed_once(table, "raw", chat_line(**parts)).select(*keep, "raw")


def build_embeddings(table: DataFrame, custom_id: Column, text: Column, model: Column, *keep: str) -> DataFrame:
    return computed_once(table, "raw", embedding_line(custom_id, text, model)).select(*keep, "raw")


def next_stage(
    results: DataFrame,
    before: str,
    after: str,
    model: Column | None,
    prefix: str = "stage2-",  # fixed values: prefix, width and max_tokens by default
    width: int = 4,
    position: str = "seq",
    max_tokens: int | None = 256,
) -> DataFrame:
    """Requests whose prompt holds the content of earlier results.

    ``results`` are lines with a 0-based ``position`` in their whole set; the id carries that number. A
    result without content gives an empty insert.
    """
    prompt = F.concat(F.lit(before), F.coalesce("content", F.lit("")), F.lit(after))
    line = chat_line(numbered(prefix, width, F.col(position)), prompt, model, max_tokens=max_tokens)
    return computed_once(extract(results), "raw", line).select(position, "raw")
