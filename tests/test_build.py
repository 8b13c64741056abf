import json

from pyspark.sql import functions as F

from reqframe.functions.jsonlines import parse_lines
from reqframe.operators.build import build_embeddings, build_requests, next_stage, numbered
from reqframe.operators.prepare import prepare_directory
from reqframe.operators.results import structured
from reqframe.sources.lines import read_lines
from reqframe.sources.sinks import write_csv
from reqframe.sources.tables import indexed_table, read_blobs, read_table
from tests.test_compare import err, res_a, res_b


def test_csv_to_requests(spark, put_file):
    path = put_file("trips.csv", 'place,note\n"north, sea","says ""hi"""\nHARBOUR,é\n')
    table = indexed_table(read_table(spark, path))
    lines = build_requests(
        table,
        "line",
        custom_id=numbered("trip/", 3, F.col("line")),
        system=F.lit("Name the weather."),
        user=F.concat("place", F.lit(" | "), "note"),
        model=F.lit("m-trip"),
        max_tokens=77,
        response_format="json_object",
    )
    got = [json.loads(r.raw) for r in lines.orderBy("line").collect()]
    assert got[0] == {
        "custom_id": "trip/001",
        "method": "POST",
        "url": "/v1/chat/completions",
        "body": {
            "model": "m-trip",
            "messages": [
                {"role": "system", "content": "Name the weather."},
                {"role": "user", "content": 'north, sea | says "hi"'},
            ],
            "max_tokens": 77,
            "response_format": {"type": "json_object"},
        },
    }
    assert got[1]["custom_id"] == "trip/002" and got[1]["body"]["messages"][1]["content"].endswith("é")


def test_embeddings(spark):
    table = spark.createDataFrame([(1, "a small text")], "n int, t string")
    raw = build_embeddings(table, numbered("emb-", 3, "n"), F.col("t"), F.lit("e")).first().raw
    assert json.loads(raw) == {"custom_id": "emb-001", "method": "POST", "url": "/v1/embeddings", "body": {"model": "e", "input": "a small text"}}


def test_next_stage(lines):
    df = next_stage(lines(res_a("x", "one"), err("y"), res_b("z", "three")), "Given:\n", "\nGo.", F.lit("m"))
    got = [json.loads(r.raw) for r in df.orderBy("pos").collect()]
    assert [(g["custom_id"], g["body"]["messages"][0]["content"]) for g in got] == [
        ("stage2-0000", "Given:\none\nGo."), ("stage2-0001", "Given:\n\nGo."), ("stage2-0002", "Given:\nthree\nGo."),
    ]


def test_structured_csv(spark, lines, tmp_path):
    rows = structured(lines(res_a("a", '{"n":"x, \\"y\\"","ok":true}'), res_a("b", '{"n":null}')), "n string, ok boolean")
    write_csv(rows.orderBy("line").select("data.*").coalesce(1), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert text == '"x, ""y""",true\n,\n'


def test_blobs(spark, put_file, tmp_path):
    path = put_file("img/a.png", b"\x00\x01")
    row = read_blobs(spark, str(tmp_path / "img")).first()
    assert (row.path, bytes(row.bytes)) == (path, b"\x00\x01")


def test_prepare_directory(spark, put_file, tmp_path):
    body = {n: [{"custom_id": f"{n}{i}", "body": {"k": i}} for i in range(50)] for n in "ab"}
    for name, rows in body.items():
        put_file(f"in/{name}.jsonl", "\n\n".join(map(json.dumps, rows)) + "\n")
    put_file("in/empty.jsonl", "")
    out = str(tmp_path / "out")
    prepare_directory(spark, str(tmp_path / "in"), out, added=['{"custom_id":"z"}'], model="n", remove="a4")
    for name, rows in body.items():
        got = [json.loads(x) for x in (tmp_path / "out" / f"{name}.jsonl").read_text().splitlines()]
        want = [{**r, "body": {**r["body"], "model": "n"}} for r in rows if "a4" not in r["custom_id"]]
        assert got == want + [{"custom_id": "z"}]
    assert (tmp_path / "out" / "empty.jsonl").read_text() == '{"custom_id":"z"}\n'
    prepare_directory(spark, str(tmp_path / "in"), out + "2", settings=["body.z..y=1"])
    got = [json.loads(x) for x in (tmp_path / "out2" / "b.jsonl").read_text().splitlines()]
    assert got == [{**r, "body": {**r["body"], "z": {"": {"y": 1}}}} for r in body["b"]]
    assert (tmp_path / "out2" / "empty.jsonl").read_text() == ""
    assert parse_lines(read_lines(spark, str(tmp_path / "in"))).where("v is null").count() == 0


def test_only_tables_of_a_row_group_are_dealt_out(spark):
    from reqframe.sources.tables import spread

    def shuffles(rows):
        return "RepartitionByExpression" in spread(spark.range(rows), "id")._jdf.queryExecution().optimizedPlan().toString()

    assert shuffles(1000) and not shuffles(20_000_000)
