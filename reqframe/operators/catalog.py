"""Listings of batches, files and models: filters, pages, progress, key lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import ascii_lower
from reqframe.functions.results import is_active, is_terminal
from reqframe.operators.joins import join_on
from reqframe.operators.ranks import Ranked

# File purposes, and the one that means every file.
DEFAULT_PURPOSE = "batch"
EVERY_PURPOSE = "all"
PURPOSES = ["batch", "batch_output", "batch_error", EVERY_PURPOSE]

# Page sizes.
DEFAULT_LIMIT = 20
MAX_LIMIT = 100


def files_by_purpose(files: DataFrame, purpose: str = DEFAULT_PURPOSE) -> DataFrame:
    return files if purpose == EVERY_PURPOSE else files.where(F.col("purpose") == purpose)


def models_by_type(models: DataFrame, model_type: str | None = None) -> DataFrame:
    """Models of one type, ASCII letter case ignored; a model without a type never matches."""
    if model_type is None:
        return models
    return models.where(ascii_lower("model_type") == ascii_lower(F.lit(model_type)))


def uuid_text(key: Column) -> Column:
    """The lower-case hyphenated UUID a key spells, or NULL if it is not UUID-shaped.

    Accepted spellings: 32 digits, hyphenated, hyphenated in braces, or as a URN. Lengths are
    looked at first, so that aliases rarely meet a regular expression.
    """
    hyphened = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    low, size = F.lower(key), F.length(key)

    def grouped(digits: Column) -> Column:
        cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        return F.concat_ws("-", *[F.substring(digits, start, n) for start, n in cuts])

    return (
        F.when((size == 36) & low.rlike(f"^{hyphened}$"), low)
        .when((size == 32) & low.rlike("^[0-9a-f]{32}$"), grouped(low))
        .when((size == 38) & low.rlike(rf"^\{{{hyphened}\}}$"), F.substring(low, 2, 36))
        .when((size == 45) & low.rlike(f"^urn:uuid:{hyphened}$"), F.substring(low, 10, 36))
    )


def resolve_models(requests: DataFrame, models: DataFrame, key: str = "model") -> DataFrame:
    """Add ``model_id`` to each row by its model key; NULL where nothing matches.

    A UUID-shaped key names an id, any other key an alias without regard to ASCII letter case. Among
    equal aliases the lowest id wins. Ids and aliases go into one lookup table with one row per
    key, so the requests are joined once.
    """
    by_id = models.select(F.concat(F.lit("id:"), F.lower("id")).alias("_key"), F.col("id").alias("model_id"))
    by_alias = models.select(F.concat(F.lit("alias:"), ascii_lower("alias")).alias("_key"), F.col("id").alias("model_id"))
    lookup = by_id.unionAll(by_alias).groupBy("_key").agg(F.min("model_id").alias("model_id"))
    by_uuid = F.concat(F.lit("id:"), uuid_text(F.col(key)))
    by_name = F.concat(F.lit("alias:"), ascii_lower(key))
    asked = requests.withColumn("_key", F.coalesce(by_uuid, by_name))
    return join_on(asked, lookup, "_key", "left", right_unique=True).drop("_key")


def _newest_first(active_first: bool) -> list[Column]:
    order = [F.col("created_at").desc(), F.col("id").desc()]
    return [is_active("status").desc(), *order] if active_first else order


def active_first(batches: DataFrame, path: str) -> Ranked:
    """All batches, active ones first, then newest first, ordered once below ``path``."""
    return Ranked.write(batches, _newest_first(True), path)


def newest_first(rows: DataFrame, path: str) -> Ranked:
    """All rows, newest first, ordered once below ``path``."""
    return Ranked.write(rows, _newest_first(False), path)


def cursor_page(
    rows: DataFrame,
    limit: int = DEFAULT_LIMIT,
    after: str | None = None,
    everything: bool = False,
    active_first: bool = False,
) -> DataFrame:
    """Rows strictly after the cursor id, newest first, with ``has_more`` on every row.

    The page is a keyset range: the cursor's row is fetched first, an unknown id raises, the rows
    after it are filtered by literals, and only the best ``limit + 1`` are kept per task.
    """
    order = _newest_first(active_first)
    if everything:
        return rows.orderBy(*order).withColumn("has_more", F.lit(False))
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be in 1..{MAX_LIMIT}")
    rank = [is_active("status")] if active_first else []
    if after is not None:
        fields = [*rank, F.col("created_at"), F.col("id")]
        found = rows.where(F.col("id") == after).select(*[c.alias(f"k{i}") for i, c in enumerate(fields)]).take(1)
        if not found:
            raise ValueError(f"unknown cursor {after!r}")
        # literals, so that the comparison can reach the scan
        later, equal = F.lit(False), F.lit(True)
        for c, value in zip(fields, found[0], strict=True):
            later, equal = later | (equal & (c < F.lit(value))), equal & (c == F.lit(value))
        rows = rows.where((F.col("created_at") <= F.lit(found[0][0])) & later if not rank else later)
    some = rows.orderBy(*order).limit(limit + 1)
    # At most limit + 1 rows reach this window.
    ranked = some.withColumn("_n", F.row_number().over(Window.orderBy(*order)))
    ranked = ranked.withColumn("has_more", F.max("_n").over(Window.partitionBy()) > limit)
    return ranked.where(F.col("_n") <= limit).orderBy("_n").drop("_n")


def page_info(page: DataFrame, position: list[Column] | None = None) -> DataFrame:
    """``has_more, first_id, last_id, rows`` of a cursor page."""
    order = F.struct("created_at", "id")
    return page.agg(
        F.coalesce(F.bool_or("has_more"), F.lit(False)).alias("has_more"),
        F.max_by("id", order).alias("first_id"),
        F.min_by("id", order).alias("last_id"),
        F.count(F.lit(1)).alias("rows"),
    )


def offset_page(ranked: Ranked, skip: int = 0, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` of a set that was ordered once (``Ranked.write``), with their ``position``."""
    return ranked.page(skip, limit)


def progress(batches: DataFrame) -> DataFrame:
    """Add ``done``, ``progress`` (NULL without counts or with total 0) and ``progress_text``."""
    counts = "request_counts"
    done = F.col(f"{counts}.completed") + F.col(f"{counts}.failed")
    total = F.col(f"{counts}.total")
    return batches.withColumns(
        {
            "done": done,
            "progress": F.when(total > 0, done.cast("double") / total),
            "progress_text": F.when(
                F.col(counts).isNotNull(), F.concat_ws("/", done.cast("string"), total.cast("string"))
            ).otherwise(F.lit("-")),
        }
    )


def progress_from_results(results: DataFrame, totals: DataFrame) -> DataFrame:
    """Per batch progress counted by request from extracted result rows and the batches' totals.

    ``results`` carry ``batch_id, custom_id, is_result, is_error``; ``totals`` are ``id, total``. A request that
    failed and then succeeded is completed once; lines without an id count each for itself.
    """
    requests = results.groupBy(F.col("batch_id").alias("id"), "custom_id").agg(
        F.count_if("is_result").alias("good"), F.count_if("is_error").alias("bad")
    )
    alone = F.col("custom_id").isNull()
    good, bad = F.col("good"), F.col("bad")
    counts = requests.groupBy("id").agg(
        F.sum(F.when(alone, good).otherwise((good > 0).cast("bigint"))).alias("completed"),
        F.sum(F.when(alone, bad).otherwise(((good == 0) & (bad > 0)).cast("bigint"))).alias("failed"),
    )
    joined = totals.select("id", "total").join(counts, "id", "left").fillna(0, ["completed", "failed"])
    return progress(joined.withColumn("request_counts", F.struct("total", "completed", "failed")))


def watch_verdict(batches: DataFrame) -> DataFrame:
    """One row over the watched batches: open ones, failed ones, and whether the run failed.

    A run fails once any batch ends in a state other than completed.
    """
    bad = is_terminal("status") & (F.col("status") != "completed")
    return batches.agg(
        F.count(F.lit(1)).alias("watched"),
        F.count_if(~is_terminal("status")).alias("open"),
        F.count_if(bad).alias("ended_badly"),
        F.coalesce(F.bool_or(bad), F.lit(False)).alias("run_failed"),
    )
