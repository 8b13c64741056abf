import pytest
from pyspark.sql import Row

from reqframe.operators.stats import (
    cost_by_model,
    cost_totals,
    request_stats,
    requests_per_model,
)
from reqframe.operators.validate import file_verdicts, validation_errors
from reqframe.sources.lines import file_list, read_lines, scan_lines


def req(cid, text, model="m", **body):
    return {
        "custom_id": cid,
        "method": "POST",
        "url": "/v1/chat/completions",
        "body": {"model": model, "messages": [{"role": "user", "content": text}], **body},
    }


F1 = [
    req("req-001", "Count to ten"),
    req("req-002", "Name three rivers of the north"),
    req("req-003", "Describe how a tide forms, in a few words."),
]


def messages(lines):
    rows = validation_errors(lines).orderBy("line", "rule").collect()
    return [(r.line, r.message.removeprefix("Missing required field: ")) for r in rows]


def test_valid_lines(lines):
    assert messages(lines(*F1)) == []


@pytest.mark.parametrize(
    "line, found",
    [
        ('[{"k": 3', ["Invalid JSON"]),
        ({"custom_id": "only"}, ["method", "url", "body"]),
        ('{"custom_id":null,"method":1,"url":[],"body":{"model":null}}', []),
        ("[1]", ["custom_id", "method", "url", "body"]),
        ({"custom_id": 1, "method": 1, "url": 1, "body": "s"}, ["body.model"]),
        ('{"a":1} x', ["Invalid JSON"]),
        ('\xa0{"custom_id":1,"method":1,"url":1,"body":{"model":1}}\x0c', []),
        ("null", ["custom_id", "method", "url", "body"]),
        ('{"custom_id":1,"method":1,"url":1,"body":{"model":"m","top":1e400}}', ["Invalid JSON"]),
        ('{"custom_id":-1' + "0" * 400 + ',"method":1,"url":1,"body":{"model":1}}', ["Invalid JSON"]),
        ('{"custom_id":1e300,"method":1e-400,"url":"1e400","body":{"model":"\\"1e999"}}', []),
    ],
)
def test_findings(lines, line, found):
    assert messages(lines(line)) == [(1, m) for m in found]


def test_files(spark, put_file, tmp_path):
    put_file("v/a.jsonl", '\n \n{"custom_id":"x"}\n')
    put_file("v/b.jsonl", '{"custom_id":1,"method":1,"url":1,"body":{"model":1}}\n')
    put_file("v/c.jsonl", "")
    put_file("v/d.jsonl", b'{"custom_id":"\xff\xfe"}\n')
    df = read_lines(spark, str(tmp_path / "v"))
    found = [(r.file[-7:], r.line, r.message[:10]) for r in validation_errors(df).collect()]
    assert sorted(found) == [("a.jsonl", 3, "Missing re")] * 3 + [("d.jsonl", 1, "Could not ")]
    verdicts = file_verdicts(df, file_list(scan_lines(spark, str(tmp_path / "v")))).orderBy("file")
    assert [(r.errors, r.valid) for r in verdicts.collect()] == [(3, False), (0, True), (0, True), (1, False)]


def stats(df):
    return tuple(request_stats(df).first())


def test_stats(lines):
    assert stats(lines(*F1)) == (3, 0, 21)
    assert requests_per_model(lines(*F1)).collect() == [Row(model="m", requests=3)]


def test_stats_by_file(lines):
    both = lines(*F1).unionAll(lines(F1[0], "{", file="g"))
    rows = request_stats(both, "file").orderBy("file").collect()
    assert [tuple(r) for r in rows] == [("f.jsonl", 3, 0, 21), ("g", 2, 1, 3)]


def test_stats_edges(lines):
    bare = [{"custom_id": c, "body": {"messages": [{"role": "user", "content": t}]}} for c, t in (("p", "rain?"), ("q", "storm"))]
    assert stats(lines(*bare)) == (2, 0, 2)
    assert requests_per_model(lines(*bare)).count() == 0
    assert stats(lines(req("a", "é" * 2))) == (1, 0, 1)
    parts = [{"type": "text", "text": "ab"}, {"type": "image_url", "image_url": {"url": "x"}}, {"text": "cd"}, "ef", {"text": 5}]
    assert stats(lines(req("a", parts))) == (1, 0, 1)
    assert stats(lines(*[req("a", "abc")] * 3)) == (3, 0, 2)
    assert stats(lines("{oops", req("a", None), req("b", 7), {"body": {"messages": "no"}}, {"body": {"messages": [1, {"content": "abcd"}]}})) == (5, 1, 1)
    assert requests_per_model(lines(req("a", "x", model=5), req("b", "x", "z"), req("c", "x", "b"))).collect() == [
        Row(model="b", requests=1),
        Row(model="z", requests=1),
    ]


def test_stats_add_up_over_merge(lines):
    a, b = lines(*F1), lines(*F1[:1])
    assert stats(a.unionAll(b))[0] == stats(a)[0] + stats(b)[0]


def test_cost(spark, lines):
    prices = spark.createDataFrame(
        [("m", "24h", "0.000000150000000", "0.000000600000001"), ("m", "1h", "1", "1")],
        "model string, completion_window string, input_price string, output_price string",
    )
    df = cost_by_model(lines(req("a", "x" * 9, max_tokens=10), req("b", "y", "q"), req("c", "x" * 3)), prices)
    rows = {r.model: r for r in df.collect()}
    assert str(rows["m"].estimated_cost) == "0.000006450000010"
    assert (rows["m"].request_count, rows["m"].estimated_input_tokens, rows["m"].estimated_output_tokens) == (2, 3, 10)
    assert rows["q"].estimated_cost is None
    totals = cost_totals(df).first()
    assert (totals.total_requests, str(totals.total_estimated_cost)) == (3, "0.000006450000010")
