import json

import pytest
from pyspark.sql import functions as F

from reqframe.operators.results import result_columns
from reqframe.functions.jsonlines import parse_lines
from reqframe.streaming.events import emit_events, terminal_events
from reqframe.streaming.results import (
    drop_relanded,
    land_results,
    latest_progress,
    result_stream,
    tail_results,
    track_progress,
)
from tests.test_compare import err, res_a


def land(spark, folder, batch, *items):
    rows = [(batch, n, i if isinstance(i, str) else json.dumps(i)) for n, i in enumerate(items)]
    land_results(spark.createDataFrame(rows, "batch_id string, pos bigint, raw string"), folder)


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_tail_delivers_each_line_once(spark, tmp_path):
    landing, out, point = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        drain(tail_results(result_stream(spark, landing, 1), out, point))
        return sorted(map(tuple, spark.read.parquet(out).select("batch_id", "raw").collect()))

    land(spark, landing, "b 1", err("x"), "", "  ")
    land(spark, landing, "b2", res_a("y", "1"))
    first = run()
    assert first == sorted([("b 1", json.dumps(err("x"))), ("b2", json.dumps(res_a("y", "1")))])
    assert run() == first
    land(spark, landing, "b 1", res_a("x", "late"), err("x"))
    assert len(run()) == 4


def test_batch_ids_survive_the_landing_path(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    ids = ["a+b:c", "007", "50%", "x y", "é"]
    for i in ids:
        land(spark, landing, i, res_a("k", "v"))
    drain(tail_results(result_stream(spark, landing), out, str(tmp_path / "cp")))
    assert sorted(r[0] for r in spark.read.parquet(out).select("batch_id").collect()) == sorted(ids)


def test_relanded_part_is_dropped_on_request(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(spark, landing, "b", res_a("x", "1"), err("x"))
    land(spark, landing, "b", res_a("x", "1"))
    stream = drop_relanded(result_stream(spark, landing))
    drain(tail_results(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("within, again, held", [("1 hour", 0, 31), ("1 millisecond", 1, 2)])
def test_relanded_lines_are_remembered_for_a_while(spark, tmp_path, within, again, held):
    """A later trigger forgets what is older than the bound, and only that."""
    landing, out, point = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        query = tail_results(drop_relanded(result_stream(spark, landing), within), out, point)
        drain(query)
        return spark.read.parquet(out).count(), [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]][-1]

    land(spark, landing, "b", *[res_a(str(i), "1") for i in range(30)])
    assert run()[0] == 30
    # the first trigger reads the time that the watermark goes by, so what is old goes in the next
    land(spark, landing, "b", res_a("x", "new"))
    run()
    land(spark, landing, "b", res_a("1", "1"))
    count, rows = run()
    assert count == 31 + again and rows <= held


def test_progress_equals_batch_counts(spark, tmp_path):
    landing, out, point = (str(tmp_path / n) for n in ("in", "out", "cp"))
    totals = spark.createDataFrame([("a", 4), ("b", 0)], "batch_id string, total bigint")

    def run():
        drain(track_progress(result_stream(spark, landing, 1), out, point))
        rows = latest_progress(spark.read.parquet(out), totals).orderBy("batch_id").collect()
        return [(r.batch_id, r.done, r.failed, r.total, r.percent) for r in rows]

    land(spark, landing, "a", res_a("1", "x"), err("2"))
    land(spark, landing, "b", err("1"), "{bad")
    assert run() == [("a", 2, 1, 4, 50), ("b", 1, 1, 0, None)]
    land(spark, landing, "a", res_a("3", "x"))
    assert run() == [("a", 3, 1, 4, 75), ("b", 1, 1, 0, None)]
    assert run() == [("a", 3, 1, 4, 75), ("b", 1, 1, 0, None)]
    land(spark, landing, "a", res_a("2", "retried"), res_a("1", "again"))
    assert run() == [("a", 3, 0, 4, 75), ("b", 1, 1, 0, None)]
    whole = parse_lines(spark.read.text(landing).select(F.col("value").alias("raw")))
    assert result_columns(whole).where("is_result").count() == 4


def test_terminal_event_once(spark, tmp_path):
    folder, out, point = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "batch_id string, status string, at timestamp"

    def add(*rows):
        df = spark.createDataFrame(rows, "batch_id string, status string, at string")
        df.withColumn("at", F.to_timestamp("at")).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema(schema).parquet(folder)
        drain(emit_events(terminal_events(stream), out, point))
        return sorted((r.batch_id, r.event) for r in spark.read.parquet(out).collect())

    add(("a", "validating", "2026-01-01 00:00:00"), *[("a", "completed", f"2026-01-01 00:00:{i:02}") for i in range(1, 40)])
    add(("b", "cancelling", "2026-01-01 00:00:00"), ("c", "expired", "2026-01-01 00:01:00"))
    assert run() == [("a", "batch.completed"), ("c", "batch.failed")]
    add(("a", "completed", "2026-02-01 00:02:00"), ("b", "cancelled", "2025-06-01 00:02:00"))
    assert run() == [("a", "batch.completed"), ("b", "batch.failed"), ("c", "batch.failed")]


def test_terminal_event_of_late_untimed_and_later_snapshots(spark, tmp_path):
    """The state store decides: no trigger reads what earlier ones wrote, and its rows are the new batches alone."""
    folder, out, point = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "batch_id string, status string, at timestamp"

    def add(*rows):
        df = spark.createDataFrame(rows, "batch_id string, status string, at string")
        df.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema(schema).parquet(folder)
        query = emit_events(terminal_events(stream), out, point)
        drain(query)
        return query, sorted(map(tuple, spark.read.parquet(out).selectExpr("batch_id", "event", "string(seen_at)").collect()), key=str)

    add(("a", "failed", None), ("b", "failed", None), ("b", "completed", "2026-01-02 00:00:00"), (None, "failed", None))
    add(("c", "expired", "1960-01-01 00:00:00"), ("c", "completed", "2026-01-01 00:00:00"), ("d", "completed", "2026-01-01 00:00:00"), ("d", "failed", "2026-01-01 00:00:00"))
    query, first = run()
    assert first == [
        ("a", "batch.failed", None),
        ("b", "batch.completed", "2026-01-02 00:00:00"),
        ("c", "batch.failed", "1960-01-01 00:00:00"),
        ("d", "batch.completed", "2026-01-01 00:00:00"),
    ]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    # earlier snapshots that come late change nothing that was told
    add(("a", "completed", "2020-01-01 00:00:00"), ("e", "failed", "2020-01-01 00:00:00"))
    query, second = run()
    assert second == sorted([*first, ("e", "batch.failed", "2020-01-01 00:00:00")], key=str)
    written = spark.read.parquet(f"{out}/epoch=*").inputFiles()
    query, third = run()
    assert third == second and spark.read.parquet(f"{out}/epoch=*").count() == 5 and len(written) > 0


def test_progress_state_ends_with_its_batch(spark, tmp_path):
    landing, ended, out, point = (str(tmp_path / n) for n in ("in", "ended", "out", "cp"))
    spark.createDataFrame([], "batch_id string").write.parquet(ended)

    def run(grace="1 hour"):
        ends = spark.readStream.schema("batch_id string").parquet(ended)
        query = track_progress(result_stream(spark, landing, 1), out, point, ends=ends, grace=grace)
        drain(query)
        rows = latest_progress(spark.read.schema("batch_id string, done bigint, failed bigint").parquet(out)).orderBy("batch_id")
        held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
        return [tuple(r) for r in rows.collect()], held

    land(spark, landing, "a", *[res_a(str(i), "x") for i in range(40)], err("x"), err(None))
    land(spark, landing, "b", err("1"), err("2"))
    rows, held = run()
    assert rows == [("a", 42, 2), ("b", 2, 2)]
    before = held[-1]
    assert 10 < before <= 16 + 2
    land(spark, landing, "a", res_a("x", "retried"))
    land(spark, landing, "b", res_a("2", "retried"))
    spark.createDataFrame([("a",)], "batch_id string").write.mode("append").parquet(ended)
    rows, _ = run()
    assert rows == [("a", 42, 1), ("b", 2, 1)]
    land(spark, landing, "b", res_a("3", "x"))
    rows, held = run("1 millisecond")
    assert rows == [("a", 42, 1), ("b", 3, 1)]
    assert held[-1] <= 3  # batch b alone
    assert spark.read.parquet(out).groupBy("batch_id", "epoch").count().where("count > 1").isEmpty()
