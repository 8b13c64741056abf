import base64
import json

import pytest
from pyspark.sql import functions as F

from reqframe.operators.prepare import append_lines, prepare, typed_value
from reqframe.sources.lines import read_lines
from tests.test_validate_stats import F1, req


def out(df):
    return [json.loads(r.raw) for r in df.orderBy("line").select("raw").collect()]


def test_nothing_to_do(lines):
    df = lines(*F1)
    assert prepare(df) is df


def test_overrides(lines):
    got = out(prepare(lines(*F1), model="new", temperature=0.25, max_tokens=90, top_p=1.0))
    want = json.loads(json.dumps(F1))
    for w in want:
        w["body"].update(model="new", temperature=0.25, max_tokens=90, top_p=1)
    assert got == want


def test_override_needs_a_body(lines):
    got = out(prepare(lines({"a": 1}, {"body": None}, {"body": {"x": None}}), model="n"))
    assert got == [{"a": 1}, {"body": {"model": "n"}}, {"body": {"x": None, "model": "n"}}]


@pytest.mark.parametrize("bad", ['{"body":[1]}', '{"body":"s"}', "{x"])
def test_bad_line(lines, bad):
    with pytest.raises(Exception, match="body is not an object|invalid JSON"):
        prepare(lines(bad), model="n").collect()
    row = prepare(lines(bad), model="n", on_bad="flag").first()
    assert row.error and row.raw == bad


@pytest.mark.parametrize(
    "text, value",
    [
        ("007", 7), ("+7", 7), ("-0", 0), ("1e3", 1000.0), ("0.9", 0.9), (".5", 0.5), ("1.", 1.0), ("true", True),
        ("null", None), ("[1]", [1]), ("abc", "abc"), ('"x"', "x"), ("NaN", None), ("-inf", None), ("1_0", "1_0"),
        ("[NaN]", "[NaN]"), ("", ""), (" 1 ", 1), ("9223372036854775808", 9.223372036854775808e18), ("٣", "٣"),
    ],
)
def test_typed_value(text, value):
    got = typed_value(text)
    assert got == value and type(got) is type(value)


@pytest.mark.parametrize(
    "line, settings, want",
    [
        ({"a": 5}, ["a.b.c=1"], {"a": {"b": {"c": 1}}}),
        ({"a": {"b": 1, "k": None}}, ["a.c=x=y"], {"a": {"b": 1, "k": None, "c": "x=y"}}),
        ({"a": {"b": 1}}, ["a=2", "a.d=3"], {"a": {"d": 3}}),
        ({"a": {"b": 1}}, ['a={"z":1}', "a.d=3"], {"a": {"z": 1, "d": 3}}),
        ({"a": {"b": 1}}, ["a.d=3", "a.e.f=4", "a.e.g=5"], {"a": {"b": 1, "d": 3, "e": {"f": 4, "g": 5}}}),
        ({"a": {"b": 1}}, ["nothing"], {"a": {"b": 1}}),
        ({"a b": {"it's": 1}}, ["a b.it's=2"], {"a b": {"it's": 2}}),
        ([1], ["a=1"], [1]),
        (None, ["a.b=1"], {"a": {"b": 1}}),
        (None, ["a=1"], None),
        ({"body": {"top_p": 1}}, ["body.top_p=0.9", "body.stream=false"], {"body": {"top_p": 0.9, "stream": False}}),
    ],
)
def test_settings(lines, line, settings, want):
    assert out(prepare(lines(line), settings=settings)) == [want]


def test_nested_setting_on_an_array_line_fails(lines):
    assert prepare(lines([1]), settings=["a.b=1"], on_bad="flag").first().error == "line is not an object"


def test_remove(lines):
    assert [x["custom_id"] for x in out(prepare(lines(*F1), remove="req-002"))] == ["req-001", "req-003"]
    kept = lines({"custom_id": "test-1"}, {"custom_id": 5}, {"x": 1}, {"custom_id": None}, {"custom_id": "a test-* b"})
    assert len(out(prepare(kept, remove="test-*"))) == 4


def test_append(lines):
    both = prepare(lines(*F1), model="n").unionByName(prepare(lines(F1[0], file="g.jsonl"), model="n"))
    extra = ' {"custom_id":"req-004",  "body":{}} '
    rows = append_lines(both, [extra, "1"]).orderBy("file", "section", "line").collect()
    assert [(r.file, r.section, r.raw[:12]) for r in rows if r.section] == [
        ("f.jsonl", 1, '{"custom_id"'), ("f.jsonl", 1, "1"), ("g.jsonl", 1, '{"custom_id"'), ("g.jsonl", 1, "1"),
    ]
    assert rows[3].raw == extra.strip() and len(rows) == 8
    with pytest.raises(ValueError):
        append_lines(both, ["{x"])


def image(url):
    return {"type": "image_url", "image_url": {"url": url, "detail": "low"}}


def test_assets(spark, lines):
    blobs = spark.createDataFrame([(p, bytearray(p.encode())) for p in ("x.PNG", "y.jpeg", "z", "a.b/c", "u.svg")], "path string, bytes binary")
    urls = ["data:q", "file://x.PNG", "y.jpeg", "z", "a.b/c", "u.svg", "y.jpeg"]
    parts = [{"type": "text", "text": "t"}, *map(image, urls), {"image_url": {"url": "z"}}, 5]
    line = req("a", parts)
    line["body"]["messages"].insert(0, {"role": "system", "content": "s"})
    line["body"]["messages"].append({"role": "user", "content": [image("z")], "k": 1})
    plain = req("b", "no image")
    got = out(prepare(lines(line, plain, {"x": 1}), blobs=blobs))

    def uri(mime, path):
        return f"data:{mime};base64,{base64.b64encode(path.encode()).decode()}"

    new = ["data:q", uri("image/png", "x.PNG"), uri("image/jpeg", "y.jpeg"), uri("image/png", "z"),
           uri("image/png", "a.b/c"), uri("image/svg+xml", "u.svg"), uri("image/jpeg", "y.jpeg")]
    line["body"]["messages"][1]["content"][1:8] = [image(u) for u in new]
    line["body"]["messages"][2]["content"] = [image(uri("image/png", "z"))]
    assert got == [line, plain, {"x": 1}]


def test_missing_asset(spark, lines):
    blobs = spark.createDataFrame([], "path string, bytes binary")
    df = lines(req("a", [image("gone.png")]), req("b", "x"))
    rows = prepare(df, blobs=blobs, on_bad="flag").orderBy("line").collect()
    assert [r.error for r in rows] == ["could not read an image", None]
    with pytest.raises(Exception, match="could not read an image"):
        prepare(df, blobs=blobs).collect()


def test_many_settings_stay_one_pass(lines):
    df = prepare(lines(*F1), settings=[f"body.k{i}=1" for i in range(20)])
    assert df.select(F.col("raw")).count() == 3


def _with_image(url):
    part = {"type": "image_url", "image_url": {"url": url}}
    return json.dumps(req("p", [part]))


def test_image_bytes_are_in_no_aggregation(spark, lines):
    """Digests stand for images, and equal images under two paths are encoded once."""
    requests = lines(req("1", [image("a.png"), image("b.png")]), req("2", [image("b.png")]))
    blobs = spark.createDataFrame([("a.png", bytearray(b"same")), ("b.png", bytearray(b"same")), ("b.png", bytearray(b"same")), ("c.png", bytearray(b"x"))], "path string, bytes binary")
    done = prepare(requests, blobs=blobs)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    urls = [[p["image_url"]["url"] for p in json.loads(r.raw)["body"]["messages"][0]["content"]] for r in done.orderBy("line").collect()]
    assert urls == [["data:image/png;base64,c2FtZQ=="] * 2, ["data:image/png;base64,c2FtZQ=="]]


def test_images_of_a_file_listed_twice(spark, put_file):
    path = put_file("i.jsonl", _with_image("a.png") + "\n" + _with_image("b.png") + "\n")
    blobs = spark.createDataFrame([(p, bytearray(p.encode())) for p in ("a.png", "b.png", "c.png")], "path string, bytes binary")
    rows = prepare(read_lines(spark, [path, path]), blobs=blobs).orderBy("seq").collect()
    urls = [json.loads(r.raw)["body"]["messages"][0]["content"][0]["image_url"]["url"] for r in rows]
    want = ["data:image/png;base64," + base64.b64encode(p).decode() for p in (b"a.png", b"b.png")]
    assert urls == want * 2


def test_two_images_under_one_path(spark, lines):
    blobs = spark.createDataFrame([("a.png", bytearray(b"1")), ("a.png", bytearray(b"2")), ("u.png", bytearray(b"3")), ("u.png", bytearray(b"3"))], "path string, bytes binary")
    assert prepare(lines(_with_image("u.png")), blobs=blobs).count() == 1
    with pytest.raises(Exception, match="different images under a.png"):
        prepare(lines(_with_image("a.png")), blobs=blobs).collect()


def test_number_out_of_range_stops(lines):
    with pytest.raises(Exception, match="invalid JSON"):
        prepare(lines('{"body":{"x":1e400}}'), model="n").collect()
