"""Inlining of referenced images as data URIs."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import (
    computed_once,
    items_at,
    members_at,
    put,
    text_at,
)
from reqframe.operators.joins import join_on

# Image types by file extension (case matters), and the type of any other file.
MIME = {
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "webp": "image/webp",
    "svg": "image/svg+xml",
}
OTHER_MIME = "image/png"


def mime_of(path: Column) -> Column:
    extension = F.regexp_extract(path, r"[^/]\.([^./]*)$", 1)
    known = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension), F.lit(OTHER_MIME))


def local_path(url: Column) -> Column:
    return F.when(url.startswith("file://"), F.substr(url, F.lit(8))).otherwise(url)


def _reference(part: Column) -> Column:
    """The URL a content part refers to, NULL for other parts and for data URIs."""
    url = text_at(part, "image_url", "url")
    wanted = (text_at(part, "type") == "image_url") & ~url.startswith("data:")
    return F.when(wanted, url)


def references(v: str = "v") -> Column:
    """All image references of a request: ``array<struct<m, p, url>>`` by message and part."""
    messages = F.coalesce(items_at(v, "body", "messages"), F.expr("cast(array() as array<variant>)"))

    def of_message(message: Column, m: Column) -> Column:
        parts = F.coalesce(items_at(message, "content"), F.expr("cast(array() as array<variant>)"))
        found = F.transform(
            parts, lambda part, p: F.struct(m.alias("m"), p.alias("p"), _reference(part).alias("url"))
        )
        return F.filter(found, lambda r: r["url"].isNotNull())

    return F.flatten(F.transform(messages, of_message))


def _with_uris(v: str, uris: str) -> Column:
    """The request with each reference replaced from ``uris``, a map keyed ``message:part``."""

    def part_of(part: Column, m: Column, p: Column) -> Column:
        uri = F.try_element_at(F.col(uris), F.concat_ws(":", m, p))
        image = put(members_at(part, "image_url"), {"url": F.to_variant_object(F.array(uri)).cast("array<variant>")[0]})
        return F.when(uri.isNotNull(), put(members_at(part), {"image_url": image})).otherwise(part)

    def of_message(message: Column, m: Column) -> Column:
        parts = items_at(message, "content")
        new = F.to_variant_object(F.transform(parts, lambda part, p: part_of(part, m, p)))
        return F.when(parts.isNotNull(), put(members_at(message), {"content": new})).otherwise(message)

    messages = F.to_variant_object(F.transform(items_at(v, "body", "messages"), of_message))
    body = put(members_at(v, "body"), {"messages": messages})
    return put(members_at(v), {"body": body})


def inline_assets(lines: DataFrame, blobs: DataFrame) -> DataFrame:
    """Replace image references in ``v`` by data URIs from ``blobs`` (``path, bytes``).

    A path that ``blobs`` lacks makes the line bad (column ``_bad``); different images under one
    path that is asked for stop the job. A line is told apart by ``seq``, so a file may be listed
    twice; lines without it need ``line``. Only the references travel to the blobs, blobs that
    nothing refers to are left out first, and a much used image is spread over many tasks; the
    lines are then joined once to their own URIs.
    """
    number = next((c for c in ("seq", "line") if c in lines.columns), None)
    if number is None:
        raise ValueError("lines need a number (seq or line) to be told apart")
    identity = [*(c for c in ("set_ord", "file") if c in lines.columns), number]
    found = computed_once(lines, "_refs", references("v"))
    refs = found.select(*identity, F.explode("_refs").alias("_r")).select(
        *identity,
        F.concat_ws(":", "_r.m", "_r.p").alias("_at"),
        local_path(F.col("_r.url")).alias("path"),
    )
    # digests stand for images up to the last join: BIGINTs, so that the aggregations hash
    digest = F.sha2("bytes", 256)
    words = {f"_d{i}": F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("bigint") for i in range(4)}
    stored = blobs.select("path", "bytes").withColumns({**words, "_at_path": F.xxhash64("path")})
    asked = join_on(stored.drop("bytes"), refs.select("path"), "path", "left_semi")
    ends = [end(w).alias(f"{w}{name}") for w in words for name, end in (("", F.min), ("_max", F.max))]
    per_path = asked.groupBy("path").agg(*ends)
    differ = reduce(or_, [F.col(w) < F.col(f"{w}_max") for w in words])
    clash = F.raise_error(F.concat(F.lit("different images under "), F.col("path")))
    per_path = per_path.select("path", *[F.when(differ, clash.cast("bigint")).otherwise(F.col(w)).alias(w) for w in words])
    # an image that is stored under many paths is encoded once, from the path of the least hash
    one_each = asked.groupBy(*words).agg(F.min("_at_path").alias("_at_path"))
    chosen = stored.join(one_each.select("_at_path", *[F.col(w).alias(f"{w}_one") for w in words]).hint("merge"), "_at_path")
    chosen = chosen.where(reduce(and_, [F.col(w) == F.col(f"{w}_one") for w in words]))
    # Some sessions break base64 text into lines; a data URI has none.
    encoded = F.replace(F.base64("bytes"), F.lit("\r\n"), F.lit(""))
    images = chosen.select(*words, encoded.alias("_image"))
    loaded = join_on(refs, per_path, "path", "inner", right_unique=True).join(images.hint("merge"), list(words))
    uri = F.concat(F.lit("data:"), mime_of(F.col("path")), F.lit(";base64,"), F.col("_image"))
    # One group is the references of one line.
    per_line = loaded.groupBy(*identity).agg(
        # a path that is listed twice gives equal entries
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct(F.col("_at"), uri.alias("_uri"))))).alias("_uris")
    )
    joined = found.join(per_line, identity, "left")
    wanted, got = F.coalesce(F.size("_refs"), F.lit(0)), F.coalesce(F.size("_uris"), F.lit(0))
    if "_bad" not in lines.columns:
        joined = joined.withColumn("_bad", F.lit(None).cast("string"))
    return (
        joined.withColumn("_bad", F.coalesce("_bad", F.when(got < wanted, F.lit("could not read an image"))))
        .withColumn("v", F.when((wanted > 0) & (got >= wanted), _with_uris("v", "_uris")).otherwise(F.col("v")))
        .drop("_refs", "_uris")
    )
