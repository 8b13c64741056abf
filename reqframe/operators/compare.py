"""Comparisons between result sets, and between requests and results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import items_at, parsed, text_at
from reqframe.functions.results import canonical, extract, with_content
from reqframe.operators.joins import join_on

SIDES = ("a", "b")
# The 64-bit words of a content's digest.
DIGEST = range(4)


def _place(lines: DataFrame, position: str | None) -> Column:
    """A line's place in its whole set: ``seq`` over all files, else ``line`` of a single file."""
    return F.col(position or ("seq" if "seq" in lines.columns else "line")).cast("bigint")


def _keyed(lines: DataFrame, side: str, position: str | None, nested_only: bool) -> DataFrame:
    """What the shuffle needs of a line: its id, position and the digest of its content.

    The digest's 256 bits are carried as four BIGINTs: with buffers of fixed width the aggregation
    hashes, where a binary buffer would make it sort.
    """
    digest = F.sha2("content", 256)
    words = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("bigint") for i in DIGEST]
    return with_content(lines, nested_only=nested_only).select(
        F.lit(side).alias("side"),
        "custom_id",
        F.col("v").isNull().alias("bad"),
        _place(lines, position).alias("at"),
        *[word.alias(f"digest_{i}") for i, word in zip(DIGEST, words, strict=True)],
    )


def _per_id(a: DataFrame, b: DataFrame, position: str | None, nested_only: bool) -> DataFrame:
    """One row per id with both sides' last digest, by one aggregation of the two sides together.

    Grouping the union replaces two de-duplications and an outer join. Partial aggregation
    reduces a frequent id, and the lines without an id, before the shuffle.
    """
    both = _keyed(a, "a", position, nested_only).unionAll(_keyed(b, "b", position, nested_only))
    columns = []
    for side in SIDES:
        mine = F.col("side") == side
        at = F.when(mine, F.col("at"))
        columns += [
            *[F.max_by(f"digest_{i}", at).alias(f"digest_{side}_{i}") for i in DIGEST],
            F.count_if(mine).alias(f"rows_{side}"),
            F.count_if(mine & F.col("bad")).alias(f"bad_{side}"),
        ]
    return both.groupBy("custom_id").agg(*columns)


def _status() -> Column:
    same = reduce(and_, [F.col(f"digest_a_{i}") == F.col(f"digest_b_{i}") for i in DIGEST])
    return (
        F.when(F.col("rows_b") == 0, "only_in_a")
        .when(F.col("rows_a") == 0, "only_in_b")
        .when(same, "identical")
        .otherwise("different")
    )


def diff_detail(
    a: DataFrame, b: DataFrame, position: str | None = None, strict_shape_a: bool = False
) -> DataFrame:
    """``custom_id, status`` with status identical, different, only_in_a or only_in_b.

    An id that repeats within a side counts with its last line by ``position`` (``seq`` if the lines
    have it, so that a set may have several files; else ``line``).
    """
    per_id = _per_id(a, b, position, strict_shape_a).where(F.col("custom_id").isNotNull())
    return per_id.select("custom_id", _status().alias("status"))


def _ids(lines: DataFrame) -> DataFrame:
    ids = parsed(lines).select(text_at("v", "custom_id").alias("custom_id"))
    return ids.where(F.col("custom_id").isNotNull())


def only_in_a(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids of side A that side B lacks."""
    return join_on(_ids(a).distinct(), _ids(b), "custom_id", "left_anti")


def diff_summary(
    a: DataFrame, b: DataFrame, position: str | None = None, strict_shape_a: bool = False
) -> DataFrame:
    """One row with the counts of :func:`diff_detail` and each side's input warnings."""
    per_id = _per_id(a, b, position, strict_shape_a).withColumn(
        "status", F.when(F.col("custom_id").isNotNull(), _status())
    )

    def n(condition: Column) -> Column:
        return F.count_if(condition)

    columns = [
        n(F.col("custom_id").isNotNull() & (F.col("rows_a") > 0)).alias("entries_a"),
        n(F.col("custom_id").isNotNull() & (F.col("rows_b") > 0)).alias("entries_b"),
        n(F.col("status").isin("identical", "different")).alias("common"),
        n(F.col("status") == "identical").alias("identical"),
        n(F.col("status") == "different").alias("different"),
        n(F.col("status") == "only_in_a").alias("only_in_a"),
        n(F.col("status") == "only_in_b").alias("only_in_b"),
    ]
    for side in SIDES:
        rows, bad = F.col(f"rows_{side}"), F.col(f"bad_{side}")
        with_id = F.col("custom_id").isNotNull()
        columns += [
            F.coalesce(F.sum(bad), F.lit(0)).alias(f"parse_errors_{side}"),
            F.coalesce(F.sum(F.when(~with_id, rows - bad)), F.lit(0)).alias(f"missing_id_{side}"),
            F.coalesce(F.sum(F.when(with_id & (rows > 0), rows - 1)), F.lit(0)).alias(f"duplicates_{side}"),
        ]
    return per_id.agg(*columns)


def input_warnings(lines: DataFrame) -> DataFrame:
    """One row for one side: ``parse_errors``, ``missing_id``, ``duplicates``."""
    ids = parsed(lines).select(F.col("v").isNull().alias("bad"), text_at("v", "custom_id").alias("custom_id"))
    per_id = ids.groupBy("custom_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))
    with_id = F.col("custom_id").isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("parse_errors"),
        F.coalesce(F.sum(F.when(~with_id, F.col("n") - F.col("bad"))), F.lit(0)).alias("missing_id"),
        F.coalesce(F.sum(F.when(with_id, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )


# Fixed value: what a comparison shows for a run without an answer.
NO_RESPONSE = "(no response)"


def compare_runs(
    requests: DataFrame, runs: dict[str, DataFrame], position: str | None = None
) -> DataFrame:
    """One row per id of the first run: the prompt and every run's answer and token counts.

    An id that repeats within a run shows its first line. The prompt is the last message's content. Requests and
    runs are stacked and grouped once by id, places only; the contents of the chosen places are joined afterwards.
    """
    names = list(runs)
    messages = items_at("v", "body", "messages")
    last = F.try_element_at(messages, F.lit(-1))
    prompt = canonical(F.try_variant_get(last, "$.content", "variant"))
    stacked = parsed(requests).select(
        F.lit(-1).alias("run"),
        text_at("v", "custom_id").alias("custom_id"),
        _place(requests, position).alias("at"),
        prompt.alias("content"),
        F.lit(None).cast("bigint").alias("prompt_tokens"),
        F.lit(None).cast("bigint").alias("completion_tokens"),
    )
    for i, name in enumerate(names):
        stacked = stacked.unionAll(
            extract(runs[name]).select(
                F.lit(i),
                "custom_id",
                _place(runs[name], position),
                F.when(~F.col("content_kind").isin("VOID"), F.col("content")),
                "prompt_tokens",
                "completion_tokens",
            )
        )
    stacked = stacked.where(F.col("custom_id").isNotNull())

    # places alone are aggregated: BIGINT buffers, which hash; contents travel once, to the ids' chosen lines
    def first(run: int, value: str) -> Column:
        return F.min(F.when(F.col("run") == run, F.col(value)))

    chosen = stacked.groupBy("custom_id").agg(first(-1, "at").alias("_asked"), *[first(i, "at").alias(f"_at_{i}") for i in range(len(names))])
    chosen = chosen.where(F.col("_at_0").isNotNull())
    # one row a line: the prompt's and each run's chosen ones
    places = F.array(
        F.struct(F.lit(-1).alias("run"), F.col("_asked").alias("at")), *[F.struct(F.lit(i).alias("run"), F.col(f"_at_{i}").alias("at")) for i in range(len(names))]
    )
    wanted = chosen.select("custom_id", F.explode(F.filter(places, lambda x: x["at"].isNotNull())).alias("_w")).select("custom_id", "_w.run", "_w.at")
    lines = stacked.join(wanted.hint("merge"), ["custom_id", "run", "at"])
    out = chosen.select("custom_id")
    for i, name in [(-1, ""), *enumerate(names)]:
        mine = lines.where(F.col("run") == i)
        if i < 0:
            mine = mine.select("custom_id", F.col("content").alias("prompt"))
        else:
            mine = mine.select(
                "custom_id",
                F.coalesce("content", F.lit(NO_RESPONSE)).alias(f"{name}_content"),
                F.col("prompt_tokens").alias(f"{name}_prompt_tokens"),
                F.col("completion_tokens").alias(f"{name}_completion_tokens"),
            )
        out = out.join(mine.hint("merge"), "custom_id", "left")
    missing = {f"{name}_content": F.coalesce(f"{name}_content", F.lit(NO_RESPONSE)) for name in names}
    return out.withColumns(missing)


def match_results(requests: DataFrame, results: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every request line with its result's columns, NULL where no result came back.

    A request whose id has several result lines appears once for each.
    """
    left = parsed(requests).select(*keep, text_at("v", "custom_id").alias("custom_id"), F.col("line").alias("request_line"))
    right = extract(results).where(F.col("custom_id").isNotNull()).select(
        "custom_id",
        F.col("line").alias("result_line"),
        "content",
        "prompt_tokens",
        "completion_tokens",
        "is_result",
        "is_error",
    )
    return join_on(left, right, "custom_id", "left")


def retry_set(requests: DataFrame, results: DataFrame) -> DataFrame:
    """The request lines whose id has an error row and no success row."""
    failed = (
        extract(results)
        .where(F.col("custom_id").isNotNull())
        .groupBy("custom_id")
        .agg(F.bool_or("is_error").alias("_failed"), F.bool_or("is_result").alias("_done"))
        .where(F.col("_failed") & ~F.col("_done"))
        .select("custom_id")
    )
    left = parsed(requests).withColumn("custom_id", text_at("v", "custom_id")).drop("v")
    return join_on(left, failed, "custom_id", "left_semi")
