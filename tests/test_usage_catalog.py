import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reqframe.operators import catalog, reports, usage
from reqframe.functions.results import extract
from reqframe.operators.compare import diff_summary
from reqframe.operators.ranks import Ranked
from reqframe.sources.catalog import read_catalog
from reqframe.sources.ids import read_ids
from tests.test_compare import err, res_a


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    def entry(i, ts, model, status, tokens, batch, price="0.000000150000000", duration=None):
        return {
            "id": i, "timestamp": ts, "method": "POST", "uri": "/x", "model": model, "status_code": status,
            "prompt_tokens": tokens, "completion_tokens": 2, "total_tokens": (tokens or 0) + 2, "batch_id": batch,
            "input_price_per_token": price, "output_price_per_token": price, "duration_ms": duration, "unknown": [1],
        }

    rows = [
        entry(1, "2026-03-30T23:59:59Z", "m", 200, 10, "b1", duration=100),
        entry(2, "2026-03-31T00:00:00Z", "m", 500, None, "b1", duration=201),
        entry(3, "2026-03-31T12:00:00.5Z", "n", 200, 30, "b2", price=None),
        entry(4, "2026-04-01T00:00:00Z", None, None, 5, None),
    ]
    path = tmp_path_factory.mktemp("log") / "log.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    return read_catalog(spark, str(path), "requests").cache()


def ids_of(df):
    return sorted(r.id for r in df.collect())


def test_log_types(log):
    row = log.where("id = 1").first()
    assert row.timestamp == datetime(2026, 3, 30, 23, 59, 59) and f"{row.input_price_per_token:f}" == "0.000000150000000"


def test_filters(log):
    assert usage.date_bound("2026-03-31") == "2026-03-31T00:00:00Z"
    assert usage.date_bound("2026-03-31T05:00:00Z") == "2026-03-31T05:00:00Z"
    assert usage.date_bound("10:00") == "10:00"
    f = usage.filter_requests
    assert ids_of(f(log, since="2026-03-31")) == [2, 3, 4]
    assert ids_of(f(log, until="2026-03-31")) == [1]
    assert ids_of(f(log, since="2026-03-31", until="2026-04-01T00:00:00Z", model="m")) == [2]
    assert ids_of(f(log, batch_id="b1", status=500)) == [2]
    assert ids_of(f(log)) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        f(log, status=600)


def test_usage(spark, log):
    prices = spark.createDataFrame([("m", "1", "2")], "model string, input_price string, output_price string")
    row = usage.usage_totals(log, prices).first().asDict()
    assert (row["total_input_tokens"], row["total_output_tokens"], row["total_request_count"]) == (45, 8, 4)
    assert (row["total_batch_count"], row["avg_requests_per_batch"]) == (2, 1.5)
    assert str(row["total_cost"]) == "0.000003150000000"  # (10+2) + (0+2) + (5+2) tokens with a price
    assert str(row["estimated_realtime_cost"]) == "18.000000000000000"
    by_model = {r.model: r for r in usage.usage_by_model(log).collect()}
    assert set(by_model) == {"m", "n"} and by_model["n"].cost == 0 and by_model["m"].request_count == 2
    empty = usage.usage_totals(log.where("false"), prices).first()
    assert (empty.total_request_count, empty.avg_requests_per_batch, empty.total_cost) == (0, 0.0, 0)


def test_analytics(spark, log):
    rows = {r.batch_id: r for r in usage.batch_analytics(log).collect()}
    assert rows["b1"].avg_duration_ms == 150.5 and rows["b1"].avg_ttfb_ms is None
    assert rows["b2"].avg_duration_ms is None and rows["b2"].total_cost is None
    asked = usage.batch_analytics_list(log, read_ids(spark, ["b2", "none", "b1", "b2"]))
    got = asked.collect()
    assert [r.batch_id for r in got] == ["b2", "none", "b1", "b2"]
    assert [r.total_requests for r in got] == [1, 0, 2, 1]
    plain = [r.value for r in reports.as_plain(asked, reports.plain_analytics(True)).collect()]
    assert plain == ["b2\t1\t32\t0.0\t0", "none\t0\t0\t0.0\t0", "b1\t2\t14\t150.5\t0.000002100000000", "b2\t1\t32\t0.0\t0"]
    first = json.loads(reports.analytics_json(asked).first().value)
    assert first["batch_id"] == "b2" and first["analytics"]["total_cost"] is None
    third = json.loads(reports.analytics_json(asked).collect()[2].value)
    assert third["analytics"]["total_cost"] == "0.000002100000000"


def test_plain_requests(log):
    rows = [r.value for r in reports.as_plain(log.orderBy("id"), reports.plain_requests()).collect()]
    assert rows[0].split("\t")[1:] == ["m", "200", "12", "100ms"] and rows[3].split("\t")[1:] == ["-", "-", "7", "-"]


def test_diff_json(lines):
    got = json.loads(reports.diff_json(diff_summary(lines(res_a("a", "x"), "{"), lines(res_a("a", "x"))), "one", "two").first().value)
    assert got["identical_responses"] == 1 and "warnings_b" not in got
    assert (got["file_a"], got["file_b"]) == ("one", "two")
    assert got["warnings_a"] == {"parse_errors": 1, "missing_id": 0, "duplicates": 0}


def test_stats_json(lines):
    set_of = lines({"body": {"model": "b", "messages": [{"content": "12345678"}]}}, {"body": {"model": "a"}}, {"body": {"model": "b"}}, "{", {"x": 1})
    assert reports.stats_json(set_of).first().value == '{"lines":5,"models":{"a":1,"b":2},"estimated_input_tokens":2,"parse_errors":1}'
    assert reports.stats_json(set_of.where("false")).first().value == '{"lines":0,"models":{},"estimated_input_tokens":0,"parse_errors":0}'


def test_report_sink(spark, log, tmp_path):
    reports.write_report(reports.as_json(log, ["id", "model"]), str(tmp_path / "r"))
    rows = [json.loads(x) for p in (tmp_path / "r").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(r["id"] for r in rows) == [1, 2, 3, 4] and {"id": 4, "model": None} in rows


@pytest.fixture(scope="module")
def batches(spark):
    rows = [
        ("a", "completed", 1, (4, 3, 1)), ("b", "in_progress", 3, (4, 1, 0)), ("c", "cancelling", 3, None),
        ("d", "expired", 2, (0, 0, 0)), ("e", "validating", 0, None),
    ]
    return spark.createDataFrame(rows, "id string, status string, created_at bigint, request_counts struct<total: bigint, completed: bigint, failed: bigint>")


def test_progress(batches):
    rows = [(r.progress, r.progress_text) for r in catalog.progress(batches).orderBy("id").collect()]
    assert rows == [(1.0, "4/4"), (0.25, "1/4"), (None, "-"), (None, "0/0"), (None, "-")]


def test_verdict(batches):
    assert tuple(catalog.watch_verdict(batches).first()) == (5, 3, 1, True)
    assert catalog.watch_verdict(batches.where("id <> 'd'")).first().run_failed is False
    assert catalog.watch_verdict(batches.where("false")).first().run_failed is False


def page(df):
    rows = df.collect()
    return [r.id for r in rows], {r.has_more for r in rows}


def test_progress_counts_requests(lines):
    landed = extract(lines(err("x"), res_a("x", "1"), res_a("x", "2"), err("y"), err("y"), {"error": "e"}, {"error": "e"})).withColumn("batch_id", F.lit("b"))
    totals = landed.sparkSession.createDataFrame([("b", 4), ("c", 2), ("d", 0)], "id string, total bigint")
    rows = {r.id: (r.completed, r.failed, r.progress, r.progress_text) for r in catalog.progress_from_results(landed, totals).collect()}
    assert rows == {"b": (1, 3, 1.0, "4/4"), "c": (0, 0, 0.0, "0/2"), "d": (0, 0, None, "0/0")}


def test_pages(batches, tmp_path):
    listed = catalog.active_first(batches, str(tmp_path / "active")).listing().orderBy("position")
    assert [(r.position, r.id) for r in listed.collect()] == list(enumerate(["b", "e", "c", "d", "a"]))
    assert page(catalog.cursor_page(batches, 2)) == (["c", "b"], {True})
    assert page(catalog.cursor_page(batches, 2, after="b")) == (["d", "a"], {True})
    assert page(catalog.cursor_page(batches, 2, after="a")) == (["e"], {False})
    assert page(catalog.cursor_page(batches, 5)) == (["c", "b", "d", "a", "e"], {False})
    assert page(catalog.cursor_page(batches, 2, after="e")) == ([], set())
    with pytest.raises(ValueError, match="unknown cursor"):
        catalog.cursor_page(batches, 2, after="nowhere")
    assert page(catalog.cursor_page(batches, 2, active_first=True)) == (["b", "e"], {True})
    assert page(catalog.cursor_page(batches, 2, after="e", active_first=True)) == (["c", "d"], {True})
    assert page(catalog.cursor_page(batches, everything=True)) == (["c", "b", "d", "a", "e"], {False})
    info = catalog.page_info(catalog.cursor_page(batches, 2)).first()
    assert (info.has_more, info.first_id, info.last_id, info.rows) == (True, "c", "b", 2)
    for bad in (0, 101):
        with pytest.raises(ValueError):
            catalog.cursor_page(batches, bad)
    ranked = Ranked.write(batches, ["id"], str(tmp_path / "ids"))
    assert [(r.position, r.id) for r in catalog.offset_page(ranked, 1, 2).orderBy("position").collect()] == [(1, "b"), (2, "c")]
    newest = catalog.newest_first(batches, str(tmp_path / "newest")).page(0, 9).orderBy("position")
    assert [r.id for r in newest.collect()] == ["c", "b", "d", "a", "e"]


def test_files_and_models(spark):
    files = spark.createDataFrame([("1", "batch"), ("2", "batch_error")], "id string, purpose string")
    assert ids_of(catalog.files_by_purpose(files)) == ["1"]
    assert ids_of(catalog.files_by_purpose(files, "all")) == ["1", "2"]
    models = spark.createDataFrame(
        [("00000000-0000-0000-0000-0000000000AB", "Big", "CHAT"), ("2", "big", None), ("3", "É", "chat")],
        "id string, alias string, model_type string",
    )
    assert ids_of(catalog.models_by_type(models, "Chat")) == ["00000000-0000-0000-0000-0000000000AB", "3"]
    keys = ["BIG", "é", "É", "000000000000000000000000000000ab", "00000000-0000-0000-0000-0000000000aB",
            "{00000000-0000-0000-0000-0000000000ab}", "urn:uuid:00000000-0000-0000-0000-0000000000ab",
            "00000000-0000-0000-0000-0000000000ff", None]
    asked = spark.createDataFrame([(k,) for k in keys], "model string")
    got = {r.model: r.model_id for r in catalog.resolve_models(asked, models).collect()}
    ab = "00000000-0000-0000-0000-0000000000AB"
    assert [got[k] for k in keys] == [ab, None, "3", ab, ab, ab, ab, None, None]


def test_catalogue_reader(spark, put_file):
    path = put_file("b.jsonl", json.dumps({"id": "x", "object": "batch", "status": "completed", "created_at": 1767225600, "metadata": {"k": "v"}, "extra": 1}) + "\n")
    row = read_catalog(spark, path, "batches").first()
    assert row.created_at == datetime(2026, 1, 1) and row.metadata == {"k": "v"} and row.request_counts is None
