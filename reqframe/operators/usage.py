"""Reports over the request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqframe.functions.money import COST, PRICE, cost
from reqframe.operators.joins import join_on


def date_bound(text: str) -> str:
    """A bare date means midnight UTC at its start; anything with a time passes unchanged."""
    return text if "T" in text or ":" in text else f"{text}T00:00:00Z"


def _instant(text: str, like) -> Column:
    """A bound in the type of the log's time column, so that it reaches the scan as it is."""
    instant = F.lit(date_bound(text)).cast("timestamp")
    return instant.cast("timestamp_ntz") if like == "timestamp_ntz" else instant


def filter_requests(
    log: DataFrame,
    model: str | None = None,
    since: str | None = None,
    until: str | None = None,
    batch_id: str | None = None,
    status: int | None = None,
) -> DataFrame:
    """The log rows that meet every given condition; times are ``since <= ts < until``."""
    if status is not None and not 100 <= status <= 599:
        raise ValueError("status must be in 100..599")
    like = dict(log.dtypes)["timestamp"]
    if since is not None:
        log = log.where(F.col("timestamp") >= _instant(since, like))
    if until is not None:
        log = log.where(F.col("timestamp") < _instant(until, like))
    for column, value in (("model", model), ("batch_id", batch_id), ("status_code", status)):
        if value is not None:
            log = log.where(F.col(column) == value)
    return log


def _row_cost() -> Column:
    return cost(
        F.col("prompt_tokens"),
        F.col("completion_tokens"),
        F.col("input_price_per_token"),
        F.col("output_price_per_token"),
    )


def _sum(column: Column | str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def usage_by_model(log: DataFrame) -> DataFrame:
    """``model, input_tokens, output_tokens, cost, request_count`` per model."""
    return (
        log.where(F.col("model").isNotNull())
        .groupBy("model")
        .agg(
            _sum("prompt_tokens").alias("input_tokens"),
            _sum("completion_tokens").alias("output_tokens"),
            _sum(_row_cost()).cast(COST).alias("cost"),
            F.count(F.lit(1)).alias("request_count"),
        )
    )


def usage_totals(log: DataFrame, realtime_prices: DataFrame) -> DataFrame:
    """The totals row of the usage report.

    Realtime prices depend only on the model, so the log is first reduced to one row per
    ``(model, batch)``: that level gives exact token sums, costs and the distinct batches, and
    the price table is looked up once per model instead of once per request.
    """
    per_batch = log.groupBy("model", "batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        _sum("prompt_tokens").alias("prompt"),
        _sum("completion_tokens").alias("completion"),
        _sum(_row_cost()).cast(COST).alias("cost"),
    )
    prices = realtime_prices.select(
        "model", F.col("input_price").cast(PRICE), F.col("output_price").cast(PRICE)
    )
    priced = join_on(per_batch, prices, "model", "left", right_unique=True)
    realtime = cost(F.col("prompt"), F.col("completion"), F.col("input_price"), F.col("output_price"))
    totals = priced.agg(
        _sum("prompt").alias("total_input_tokens"),
        _sum("completion").alias("total_output_tokens"),
        _sum("n").alias("total_request_count"),
        F.count_distinct("batch_id").alias("total_batch_count"),
        _sum(F.when(F.col("batch_id").isNotNull(), F.col("n"))).alias("_in_batches"),
        _sum("cost").cast(COST).alias("total_cost"),
        _sum(realtime).cast(COST).alias("estimated_realtime_cost"),
    )
    average = F.try_divide(F.col("_in_batches").cast("double"), F.col("total_batch_count").cast("double"))
    return totals.withColumn("avg_requests_per_batch", F.coalesce(average, F.lit(0.0))).drop("_in_batches")


def batch_analytics(log: DataFrame) -> DataFrame:
    """Per batch: requests, tokens, average latency and time to first byte, cost.

    Averages are NULL without values; cost is NULL when no row of the batch has a price.
    """
    return (
        log.where(F.col("batch_id").isNotNull())
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            _sum("prompt_tokens").alias("total_prompt_tokens"),
            _sum("completion_tokens").alias("total_completion_tokens"),
            _sum("total_tokens").alias("total_tokens"),
            F.avg("duration_ms").alias("avg_duration_ms"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            F.sum(_row_cost()).cast(COST).alias("total_cost"),
        )
    )


def batch_analytics_list(log: DataFrame, ids: DataFrame) -> DataFrame:
    """One analytics row per requested id, in request order and with repeats.

    Only the requested batches are aggregated. An id without requests has zero counts.
    """
    wanted = ids.select(F.col("id").alias("batch_id")).distinct()
    analytics = batch_analytics(join_on(log, wanted, "batch_id", "left_semi"))
    asked = ids.select("ordinal", F.col("id").alias("batch_id"))
    rows = asked.join(analytics, "batch_id", "left").fillna(
        0, ["total_requests", "total_prompt_tokens", "total_completion_tokens", "total_tokens"]
    )
    return rows.orderBy("ordinal")
