"""Results delivered as they land, and progress counted from them.

Producers land finished part files below one folder per batch, ``batch_id=<id>/``. Spark reads a
file once, so a part file must be complete and must not grow.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reqframe.functions.jsonlines import is_blank, parse_lines
from reqframe.functions.results import extract
from reqframe.session import shared_dir
from reqframe.sources.sinks import PART_BYTES, sized_parts

def land_results(lines: DataFrame, landing: str, part_bytes: int = PART_BYTES) -> None:
    """Write result lines (``batch_id, pos, raw``) as part files the way a producer would.

    Lines are gathered by batch, so that each task does not leave a small file for every batch,
    but in parts by bytes, so that a very large batch is written by many tasks. Each line is moved once. The sizes of
    the parts are kept in the folder that the cluster shares.
    """
    sized = lines.withColumn("size", F.octet_length("raw") + F.lit(1))
    working = f"{shared_dir(lines.sparkSession)}/landing-{uuid.uuid4().hex}"
    parts = sized_parts(sized, "batch_id", "pos", "size", working, part_bytes)
    placed = parts.repartition("batch_id", "_part").select("batch_id", F.col("raw").alias("value"))
    placed.write.mode("append").partitionBy("batch_id").text(landing, lineSep="\n")


def result_stream(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of ``batch_id, raw, landed_at`` over the part files of all batches.

    The batch id is the folders' partition column, read as text, so that any id survives.
    """
    reader = spark.readStream.schema("value string, batch_id string").option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = F.expr(r"CASE WHEN endswith(value, '\r') THEN left(value, length(value) - 1) ELSE value END")
    return (
        reader.text(landing)
        .select(
            "batch_id",
            raw.alias("raw"),
            F.col("_metadata.file_modification_time").alias("landed_at"),
        )
        .where(~is_blank("raw"))
    )


def drop_relanded(stream: DataFrame, within: str | None = None) -> DataFrame:
    """Guard against producers that land the same part twice: equal lines of a batch pass once.

    Needed only for such producers, as the file log already delivers each part exactly once.
    Repeated ids are no duplicates: an error line and the success of its retry are different
    lines and both pass. The state keeps a digest of every line; the digest in the key spreads a large batch.

    ``within`` (``"2 days"``) bounds that state: a digest is dropped by the first trigger that is so much later than the one
    that read its line, and a line that is landed again after that passes again. Time is that of triggers, so a
    part with an old time may hold new lines all the same.
    """
    keyed = stream.withColumn("_digest", F.sha2("raw", 256))
    key = ["batch_id", "_digest"]
    if within is None:
        return keyed.dropDuplicates(key).drop("_digest")
    seen = keyed.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", within)
    return seen.dropDuplicatesWithinWatermark(key).drop("_digest", "_seen")


def tail_results(
    stream: DataFrame, out: str, checkpoint: str, follow: str | None = None
) -> StreamingQuery:
    """Append every landed line to ``out`` exactly once; order across batches is not kept.

    The checkpoint holds the position, so a restart goes on where the last run ended. Without
    ``follow`` the query drains what is there and stops; with it (``"10 seconds"``) it keeps
    looking at that interval.
    """
    writer = stream.select("batch_id", "raw").writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=follow) if follow else writer.trigger(availableNow=True)
    return writer.option("path", out).outputMode("append").start()


# Kinds of rows that the progress state is fed with; lines without an id are marked besides.
_SUCCESS, _ERROR, _END, _NO_ID = 1, 2, 4, 8

_PROGRESS = "batch_id string, done bigint, failed bigint"
_STATE = "digests binary, kinds binary, ended boolean"


def _merged(digests: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry for each request, with all its kinds."""
    if not len(digests):
        return digests, kinds
    order = np.argsort(digests, kind="stable")
    digests, kinds = digests[order], kinds[order]
    first = np.flatnonzero(np.diff(digests, prepend=digests[0] - np.uint64(1)))
    return digests[first], np.bitwise_or.reduceat(kinds, first)


def _counted(key, frames, state: GroupState):
    """Changes of a slice's counts. Its state is a sorted digest and a byte for each of its requests."""
    if state.hasTimedOut:
        state.remove()
        return
    old, old_kinds, ended = np.zeros(0, np.uint64), np.zeros(0, np.uint8), False
    if state.exists:
        blob, kinds, ended = state.get
        old, old_kinds = np.frombuffer(blob, np.uint64), np.frombuffer(kinds, np.uint8)
    digests, kinds = old, old_kinds
    done = failed = now = 0
    for frame in frames:
        now = max(now, int(frame["at"].max().timestamp() * 1000))
        kind = frame["kind"].to_numpy().astype(np.uint8)
        ended = ended or bool((kind == _END).any())
        done, failed = done + int((kind > _NO_ID).sum()), failed + int((kind == _NO_ID + _ERROR).sum())
        mine = kind < _END
        new = frame["digest"].to_numpy()[mine].view(np.uint64)
        digests, kinds = _merged(np.concatenate([digests, new]), np.concatenate([kinds, kind[mine]]))
    done += len(digests) - len(old)
    failed += int((kinds == _ERROR).sum() - (old_kinds == _ERROR).sum())
    state.update((digests.tobytes(), kinds.tobytes(), ended))
    if ended:
        state.setTimeoutTimestamp(max(now, state.getCurrentWatermarkMs() + 1))
    if done or failed:
        yield pd.DataFrame({"batch_id": [key[0]], "done": [done], "failed": [failed]})


def progress_changes(stream: DataFrame, ends: DataFrame | None = None, slices: int = 16, grace: str = "10 minutes") -> DataFrame:
    """Changes ``batch_id, done, failed`` of a result stream's counts by request, a few rows a batch and trigger.

    A request that failed and then succeeded is done once and no longer failed; lines without an id count each
    for itself. A batch's requests are dealt to ``slices``, so a large batch is many tasks' work and no state row
    holds all of it; a slice keeps nine bytes a request (a 64-bit digest of the id within its slice).

    ``ends`` is a stream with the ``batch_id`` of batches that have ended. Their requests are dropped by the first trigger
    later than ``grace`` after their last one; a part that lands even later counts as new. Time is that of triggers,
    so that no line is ever too late.
    """
    parsed = extract(parse_lines(stream)).where(F.col("is_result") | F.col("is_error"))
    place = F.coalesce(F.crc32(F.col("custom_id").cast("binary")), F.xxhash64("raw"))
    rows = parsed.select(
        "batch_id",
        F.pmod(place, F.lit(slices)).cast("int").alias("slice"),
        F.xxhash64("custom_id").alias("digest"),
        (F.when(F.col("is_result"), _SUCCESS).otherwise(_ERROR) + F.when(F.col("custom_id").isNull(), _NO_ID).otherwise(0)).alias("kind"),
    )
    if ends is not None:
        every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
        end = ends.select("batch_id", every.alias("slice"), F.lit(0).cast("bigint").alias("digest"), F.lit(_END).alias("kind"))
        rows = rows.unionByName(end)
    rows = rows.withColumn("at", F.current_timestamp())
    if ends is not None:
        rows = rows.withWatermark("at", grace)
    # without ends nothing is ever due, and no trigger has to look for it
    timeout = GroupStateTimeout.NoTimeout if ends is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("batch_id", "slice").applyInPandasWithState(_counted, _PROGRESS, _STATE, "update", timeout)


def track_progress(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    follow: str | None = None,
    ends: DataFrame | None = None,
    grace: str = "10 minutes",
) -> StreamingQuery:
    """Write each trigger's changes to ``out``, one folder per trigger with one row for each batch that changed.

    A repeated trigger overwrites its own folder, so a restart cannot count twice. See :func:`progress_changes`.
    """

    def write(changed: DataFrame, epoch: int) -> None:
        total = changed.groupBy("batch_id").agg(F.sum("done").alias("done"), F.sum("failed").alias("failed"))
        total.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    writer = progress_changes(stream, ends, grace=grace).writeStream.foreachBatch(write).outputMode("update")
    writer = writer.trigger(processingTime=follow) if follow else writer.trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def latest_progress(progress: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """``batch_id, done, failed`` by request, with ``total`` and whole ``percent`` where totals are known.

    ``progress`` are the rows that :func:`track_progress` wrote.
    """
    newest = progress.groupBy("batch_id").agg(F.sum("done").alias("done"), F.sum("failed").alias("failed"))
    if totals is None:
        return newest
    joined = newest.join(totals.select("batch_id", "total"), "batch_id", "left")
    return joined.withColumn("percent", F.when(F.col("total") > 0, F.expr("done * 100 div total")))


__all__ = [
    "drop_relanded",
    "land_results",
    "latest_progress",
    "progress_changes",
    "result_stream",
    "tail_results",
    "track_progress",
]
