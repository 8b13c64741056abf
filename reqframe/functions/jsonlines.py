"""JSON text and VARIANT expressions for request and result lines."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Closes the wrapper array around a line. It is drawn anew in every process, so no stored
# line can contain it, and a line that ends the array early cannot forge it.
_SEAL = uuid.uuid4().hex


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(raw: Column | str) -> Column:
    """``raw`` without white space at either end. Lines that are one object skip the scan."""
    raw = _col(raw)
    return F.when(raw.startswith("{") & raw.endswith("}"), raw).otherwise(
        F.btrim(raw, F.lit(WHITE_SPACE))
    )


def is_blank(raw: Column | str) -> Column:
    """True for an empty or white-space-only line."""
    raw = _col(raw)
    return F.when(raw.startswith("{"), F.lit(False)).otherwise(
        F.btrim(raw, F.lit(WHITE_SPACE)) == ""
    )


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a costly column that filters and projections above it must not compute again.

    The optimizer moves a filter below the projection that defines its column and so copies the
    definition, once per use. It leaves a generator's output where it is, while filters on the
    other columns still pass. A one-element array yields exactly one row, NULL included.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode_outer(F.array(value)).alias(name))


# A \\u escape of half a surrogate pair. The parser takes it, strict JSON readers do not.
_HALF_PAIR = (
    r"(?i)(?<!\\)(?:\\\\)*\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f][0-9a-f]{2})"
    r"|(?i)(?<!\\ud[89ab][0-9a-f]{2})(?<!\\)(?:\\\\)*\\ud[c-f][0-9a-f]{2}"
)


def _half_pair(raw: Column) -> Column:
    escaped = raw.contains("\\ud") | raw.contains("\\uD")
    return F.when(escaped, raw.rlike(_HALF_PAIR)).otherwise(F.lit(False))


# What a number outside the double range must have: a long exponent or very many digits.
_LONG_NUMBER = r"[0-9][eE]\+?[0-9]{3}|[0-9]{200}"
_NUMBER = r"[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


def _too_large(raw: Column) -> Column:
    """True if a number of the line is outside the double range. The parser makes it infinite,
    strict JSON readers refuse it. Few lines pass the first look, so few are searched."""
    no_texts = F.regexp_replace(F.regexp_replace(raw, r"\\.", ""), r'"[^"]*"', '""')
    numbers = F.regexp_extract_all(no_texts, F.lit(_NUMBER), F.lit(0))
    infinite = F.exists(numbers, lambda n: n.cast("double") == F.lit(float("inf")))
    return F.when(raw.rlike(_LONG_NUMBER), infinite).otherwise(F.lit(False))


# Fixed value: the levels of arrays and objects that strict JSON readers of this format allow.
MAX_DEPTH = 127


def _too_deep(raw: Column) -> Column:
    """True if a line nests deeper than ``MAX_DEPTH``. Only lines with that many opening brackets are scanned:
    texts are taken out, and the level is summed up along the brackets that are left."""
    opening = F.length(raw) - F.length(F.translate(raw, "[{", ""))
    no_texts = F.regexp_replace(F.regexp_replace(raw, r"\\.", ""), r'"[^"]*"', "")
    brackets = F.split(F.regexp_replace(no_texts, r"[^\[\]{}]", ""), "")
    start = F.struct(F.lit(0).alias("level"), F.lit(0).alias("most"))

    def step(at: Column, bracket: Column) -> Column:
        level = at["level"] + F.when(bracket.isin("[", "{"), 1).when(bracket.isin("]", "}"), -1).otherwise(0)
        return F.struct(level.alias("level"), F.greatest(at["most"], level).alias("most"))

    deep = F.aggregate(brackets, start, step, lambda at: at["most"]) > MAX_DEPTH
    return F.when(opening > MAX_DEPTH, deep).otherwise(F.lit(False))


def parse_lines(df: DataFrame, raw: str = "raw", out: str = "v", trim: bool = False) -> DataFrame:
    """Add ``out``: the VARIANT of each line, NULL where the text is not exactly one JSON value.

    ``try_parse_json`` stops after the first value and ignores what follows it, so the text is
    parsed as the first element of an array whose second element is the seal. Any trailing text
    either breaks that array or keeps the seal from being its second and last element. One
    parse per line is enough this way.
    """
    text = trimmed(raw) if trim else F.col(raw)
    sealed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_SEAL}"]')))
    whole = (
        (F.try_variant_get("_sealed", "$[1]", "string") == _SEAL)
        & F.try_variant_get("_sealed", "$[2]", "variant").isNull()
        & F.is_valid_utf8(F.col(raw))
        & ~_half_pair(F.col(raw))
        & ~_too_large(F.col(raw))
        & ~_too_deep(F.col(raw))
    )
    value = F.when(whole, F.try_variant_get("_sealed", "$[0]", "variant"))
    return computed_once(df.withColumn("_sealed", sealed), out, value).drop("_sealed")


def parsed(lines: DataFrame) -> DataFrame:
    """Lines with ``v``, parsed here unless the caller already did."""
    return lines if "v" in lines.columns else parse_lines(lines)


def path_of(*keys: str | int) -> str:
    """A VARIANT path through object keys and array positions."""
    steps = []
    for key in keys:
        if isinstance(key, int):
            steps.append(f"[{key}]")
        elif '"' not in key:
            steps.append(f'["{key}"]')
        elif "'" not in key:
            steps.append(f"['{key}']")
        else:
            raise ValueError(f"a path key may not hold both kinds of quotes: {key!r}")
    return "$" + "".join(steps)


def member(v: Column | str, *keys: str | int) -> Column:
    """The VARIANT at a path. NULL only when the path is absent; JSON null is not NULL."""
    return F.try_variant_get(_col(v), path_of(*keys), "variant")


def has(v: Column | str, *keys: str | int) -> Column:
    """Presence of a path, whatever its value, JSON null included."""
    return member(v, *keys).isNotNull()


def kind(x: Column) -> Column:
    """``STRING``, ``VOID`` (JSON null), ``ARRAY<…>``, ``OBJECT<…>`` …; NULL when absent."""
    return F.schema_of_variant(x)


def is_object(x: Column) -> Column:
    return F.coalesce(kind(x).startswith("OBJECT"), F.lit(False))


def text_of(x: Column) -> Column:
    """A VARIANT's text if it is a JSON string, else NULL. A plain get would cast numbers too."""
    return F.when(kind(x) == "STRING", F.try_variant_get(x, "$", "string"))


def text_at(v: Column | str, *keys: str | int) -> Column:
    """The JSON string at a path, NULL for any other type."""
    return text_of(member(v, *keys))


def items_at(v: Column | str, *keys: str | int) -> Column:
    """The array at a path as ``array<variant>``, NULL for any other type."""
    return F.try_variant_get(_col(v), path_of(*keys), "array<variant>")


def members_at(v: Column | str, *keys: str | int) -> Column:
    """The object at a path as ``map<string,variant>``, NULL for any other type."""
    return F.try_variant_get(_col(v), path_of(*keys), "map<string,variant>")


def no_members() -> Column:
    return F.expr("cast(map() as map<string,variant>)")


def put(members: Column, values: dict[str, Column]) -> Column:
    """An object VARIANT: ``members`` with the given keys replaced or added."""
    keys = list(values)
    kept = F.map_filter(members, lambda k, _: ~k.isin(keys))
    added = F.create_map(*[part for k in keys for part in (F.lit(k), values[k])])
    return F.to_variant_object(F.map_concat(kept, added))


# The letters whose case some comparisons ignore.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(x: Column | str) -> Column:
    """Text with only the ASCII letters lowered."""
    return F.translate(_col(x), _UPPER, _LOWER)
