"""One event when a batch first reaches a terminal state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reqframe.functions.results import is_terminal

# Event kinds.
COMPLETED = "batch.completed"
FAILED = "batch.failed"

_WRITTEN = "batch_id string, event string, seen_at timestamp, epoch bigint"


def event_kind(status: str = "status"):
    return F.when(F.col(status) == "completed", F.lit(COMPLETED)).otherwise(F.lit(FAILED))


def terminal_events(snapshots: DataFrame) -> DataFrame:
    """``batch_id, event, seen_at`` of the terminal ones of status snapshots (``batch_id, status, at``).

    Snapshots may come late and repeat; :func:`emit_events` makes them one event for each batch.
    """
    ended = snapshots.where(is_terminal("status") & F.col("batch_id").isNotNull())
    return ended.select("batch_id", event_kind().alias("event"), F.col("at").alias("seen_at"))


# The order of a batch's snapshots as one number: time, then kind. Snapshots without a time come last.
_UNTIMED = 1 << 60


def _packed() -> Column:
    time = F.coalesce(F.unix_micros("seen_at"), F.lit(_UNTIMED))
    return time * 2 + (F.col("event") == FAILED).cast("bigint")


def first_events(events: DataFrame) -> DataFrame:
    """A stream of ``batch_id, event, seen_at`` with ``new_at`` and ``changed_at``, one row per batch and trigger.

    One state row a batch keeps its earliest snapshot and the trigger that first saw it, so that a batch told
    before is known without reading what was written. All of it is BIGINTs: a batch with many snapshots is
    reduced by hashing before the shuffle. A batch is new in a trigger if ``new_at`` equals ``changed_at``.
    """
    # the same for all rows of a trigger, and again when a trigger is repeated
    trigger = F.unix_millis(F.current_timestamp())
    marked = events.select("batch_id", _packed().alias("first"), trigger.alias("at"))
    state = marked.groupBy("batch_id").agg(F.min("first").alias("first"), F.min("at").alias("new_at"), F.max("at").alias("changed_at"))
    time = F.shiftright("first", 1)
    return state.select(
        "batch_id",
        F.when(F.col("first").bitwiseAND(F.lit(1)) == 1, FAILED).otherwise(COMPLETED).alias("event"),
        F.when(time != _UNTIMED, F.timestamp_micros(time)).alias("seen_at"),
        "new_at",
        "changed_at",
    )


def emit_events(
    events: DataFrame, out: str, checkpoint: str, follow: str | None = None
) -> StreamingQuery:
    """Append one event per batch to ``out``, one folder per trigger; see :func:`read_events`.

    Of the snapshots of the trigger that first sees a batch end, the earliest is its event, untimed ones last, completed
    before failed at one time. No time bound decides what is an event and no trigger reads what earlier ones
    wrote: the state store knows the batches. A repeated trigger overwrites its own folder, so a restart emits
    nothing twice.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        new = rows.where("new_at = changed_at").select("batch_id", "event", "seen_at")
        new.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    writer = first_events(events).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=follow) if follow else writer.trigger(availableNow=True)
    return writer.start()


def read_events(frame: DataFrame, out: str) -> DataFrame:
    """The events below ``out`` with the trigger (``epoch``) that wrote them; ``frame`` gives the session."""
    return frame.sparkSession.read.schema(_WRITTEN).parquet(out)
