"""Rewriting request lines: drop, override, set, inline, append."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import (
    WHITE_SPACE,
    has,
    kind,
    member,
    members_at,
    no_members,
    parse_lines,
    put,
    text_at,
)
from reqframe.operators.assets import inline_assets
from reqframe.sources.lines import file_list, index_lines, scan_lines
from reqframe.sources.sinks import write_by_file

_FLOAT = re.compile(r"[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|infinity|nan)", re.I | re.A)
_INT = re.compile(r"[+-]?\d+", re.A)


def _reject(name: str):
    raise ValueError(name)


def strict_loads(text: str):
    """JSON as the format defines it; Python's NaN and Infinity extensions are refused."""
    return json.loads(text, parse_constant=_reject)


def typed_value(text: str):
    """The value a ``path=text`` setting stands for.

    Literals come first, then 64-bit integers, then floats (non-finite ones become null), then
    JSON, and anything else is text.
    """
    literals = {"true": True, "false": False, "null": None}
    if text in literals:
        return literals[text]
    if _INT.fullmatch(text) and -(2**63) <= int(text) < 2**63:
        return int(text)
    if _FLOAT.fullmatch(text):
        number = float(text)
        return number if math.isfinite(number) else None
    try:
        return strict_loads(text)
    except ValueError:
        return text


def _literal(value) -> Column:
    return F.parse_json(F.lit(json.dumps(value, ensure_ascii=False, allow_nan=False)))


@dataclass
class _Patch:
    """What a list of settings does to one object: replace members or patch them further."""

    members: dict[str, "_Patch | object"] = field(default_factory=dict)

    def set(self, keys: Sequence[str], value) -> None:
        head, rest = keys[0], keys[1:]
        if not rest:
            self.members[head] = value
            return
        below = self.members.get(head, _MISSING)
        if below is _MISSING:
            below = self.members[head] = _Patch()
        if isinstance(below, _Patch):
            below.set(rest, value)
        else:
            # The member was already replaced by a setting: go on inside that value.
            self.members[head] = _set_plain(below, rest, value)


_MISSING = object()


def _set_plain(base, keys: Sequence[str], value):
    out = dict(base) if isinstance(base, dict) else {}
    out[keys[0]] = value if len(keys) == 1 else _set_plain(out.get(keys[0]), keys[1:], value)
    return out


def _patched(v: str, at: tuple[str, ...], patch: _Patch) -> Column:
    """The object at a path with a patch applied; anything but an object counts as empty."""
    values = {
        name: _patched(v, (*at, name), change) if isinstance(change, _Patch) else _literal(change)
        for name, change in patch.members.items()
    }
    return put(F.coalesce(members_at(v, *at), no_members()), values)


def parse_settings(settings: Sequence[str]) -> list[tuple[list[str], object]]:
    """``path=value`` texts, split at the first ``=``; a text without one is ignored."""
    pairs = [s.split("=", 1) for s in settings if "=" in s]
    return [(path.split("."), typed_value(text)) for path, text in pairs]


def drop_by_id(lines: DataFrame, pattern: str) -> DataFrame:
    """Drop lines whose string ``custom_id`` contains the text; other lines stay."""
    return lines.where(~F.coalesce(F.contains(text_at("v", "custom_id"), F.lit(pattern)), F.lit(False)))


def _override_body(lines: DataFrame, values: dict[str, object]) -> DataFrame:
    """Set members of ``body`` where a body exists. A null body becomes an object."""
    body = member("v", "body")
    replaced = put(
        F.coalesce(members_at("v", "body"), no_members()), {k: _literal(x) for k, x in values.items()}
    )
    usable = members_at("v", "body").isNotNull() | (kind(body) == "VOID")
    return lines.withColumn(
        "_bad", F.coalesce("_bad", F.when(has("v", "body") & ~usable, F.lit("body is not an object")))
    ).withColumn(
        "v",
        F.when(has("v", "body") & usable, put(members_at("v"), {"body": replaced})).otherwise(F.col("v")),
    )


def _apply_settings(lines: DataFrame, settings: Sequence[str]) -> DataFrame:
    """All settings as one nested rewrite, whatever their number and order."""
    patch = _Patch()
    pairs = parse_settings(settings)
    for keys, value in pairs:
        patch.set(keys, value)
    if not pairs:
        return lines
    root_object = members_at("v").isNotNull()
    nested = any(len(keys) > 1 for keys, _ in pairs)
    # A root that is no object cannot take a one-part path, and that is no error; a longer path
    # turns a null root into an object and fails on any other.
    null_root = kind(F.col("v")) == "VOID"
    bad = F.when(~root_object & ~null_root, F.lit("line is not an object")) if nested else F.lit(None)
    take = (root_object | null_root) if nested else root_object
    return lines.withColumn("_bad", F.coalesce("_bad", bad.cast("string"))).withColumn(
        "v", F.when(take, _patched("v", (), patch)).otherwise(F.col("v"))
    )


def prepare(
    lines: DataFrame,
    model: str | None = None,
    temperature: float | None = None,
    max_tokens: int | None = None,
    top_p: float | None = None,
    settings: Sequence[str] = (),
    remove: str | None = None,
    blobs: DataFrame | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """Rewrite request lines, in this order: remove, overrides, settings, asset inlining.

    ``raw`` and ``v`` are replaced, the other columns stay, rows are not shuffled (except to
    look up assets). Without any option the lines come back unchanged. A bad line stops the job
    with ``on_bad="fail"``; with ``"flag"`` it keeps its text and gets an ``error``.
    """
    overrides = {
        name: value
        for name, value in (
            ("model", model),
            ("temperature", temperature),
            ("max_tokens", max_tokens),
            ("top_p", top_p),
        )
        if value is not None
    }
    if not (overrides or settings or remove is not None or blobs is not None):
        return lines
    keep = lines.columns
    work = parse_lines(lines.drop("v"), trim=True)
    if remove is not None:
        work = drop_by_id(work, remove)
    work = work.withColumn("_bad", F.when(F.col("v").isNull(), F.lit("invalid JSON")))
    if overrides:
        work = _override_body(work, overrides)
    if settings:
        work = _apply_settings(work, settings)
    if blobs is not None:
        work = inline_assets(work, blobs)
    if on_bad == "fail":
        fault = F.concat(F.col("_bad"), F.lit(": "), F.left("raw", F.lit(200)))
        text = F.when(F.col("_bad").isNotNull(), F.raise_error(fault)).otherwise(F.to_json("v"))
        return work.withColumn("raw", text).select(*keep)
    text = F.when(F.col("_bad").isNotNull(), F.col("raw")).otherwise(F.to_json("v"))
    return work.withColumn("raw", text).withColumn("error", F.col("_bad")).select(*keep, "error")


def prepare_directory(
    spark: SparkSession, source: str, target: str, added: Sequence[str] = (), **options
) -> None:
    """Rewrite every ``.jsonl`` file of a folder, or one file, into the new folder ``target``.

    One job covers all files; each keeps its name and its line order, files without lines too.
    """
    scan = scan_lines(spark, source)
    files = file_list(scan)
    lines = prepare(index_lines(scan).drop("pos"), **options)
    if not added:
        write_by_file(lines, target, files)
        return
    whole = append_lines(lines.drop("file_ord", "seq"), added, files)
    place = F.when(F.col("section") == 0, F.col("line")).otherwise(F.col("line") + F.lit(1 << 61))
    write_by_file(whole.withColumn("place", place), target, files, "place")


def append_lines(lines: DataFrame, added: Sequence[str], files: DataFrame | None = None) -> DataFrame:
    """Add literal lines after the last line of every file.

    Each must be JSON and is kept as trimmed text, untouched by any rewrite. Adds ``section``:
    0 for the data, 1 for added lines; order by ``file_ord, section, line``.
    """
    for text in added:
        try:
            strict_loads(text)
        except ValueError as fault:
            raise ValueError(f"invalid JSON in an added line: {fault}") from fault
    data = lines.withColumn("section", F.lit(0))
    if not added:
        return data
    at = [c for c in ("file", "file_ord") if c in lines.columns]
    if files is None:
        # the files of the lines that are left: pass ``files`` when lines were removed before
        files = lines.select(*at).distinct()
    literal = F.array(*[F.struct(F.lit(i + 1).alias("line"), F.lit(t.strip(WHITE_SPACE)).alias("raw")) for i, t in enumerate(added)])
    extra = files.select(*at, F.explode(literal).alias("_x")).select(
        *at, F.col("_x.line").cast("bigint").alias("line"), F.col("_x.raw").alias("raw"), F.lit(1).alias("section")
    )
    if "v" in lines.columns:
        extra = parse_lines(extra)
    return data.unionByName(extra, allowMissingColumns=True)
