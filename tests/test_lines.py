import json

import pytest
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import has, is_blank, parse_lines, text_at, trimmed
from reqframe.operators.prepare import prepare_directory
from reqframe.sources.ids import read_ids
from reqframe.sources.lines import file_list, index_lines, read_lines, scan_lines


@pytest.mark.parametrize("trim", [False, True])
def test_strict_json(spark, trim):
    good = ['{"a":1}', ' {"b":[1]} ', "null", "true", "1", '"x"', '{"a":1,"a":2}', "[[1],[2]]", '"],["',
            r'"\ud83d\ude00"', r'"\\ud800"', r'"x\\\uD83D\uDE00 \ud83d\ude00"']
    bad = [
        '{"a":1} x', "1 2", "1],[2", '1},{"v":2', '1,"v":3', "]", "", "  ", "NaN", "Infinity", "[1,2",
        '"a\tb"', "01", '{"a":1}//c', "-", "1,2", '{"a":NaN}', "{'a':1}", "﻿{}", '1,"x"],["', r'"\ud800"',
        r'"\ud800\ud800\udc00"', r'"\udc00"', r'"\\\ud800"', r'"\ud83d\ude00\ude00"',
    ]
    frame = spark.createDataFrame([(r, r in good) for r in good + bad], "raw string, good boolean")
    wrong = parse_lines(frame, trim=trim).where(F.col("v").isNotNull() != F.col("good"))
    assert [r.raw for r in wrong.collect()] == []


def test_last_repeated_key_wins(spark):
    v = parse_lines(spark.createDataFrame([('{"a":1,"a":2}',)], "raw string"))
    assert v.select(F.to_json("v")).first()[0] == '{"a":2}'


def test_presence_and_text(lines):
    df = lines({"a": None, "b": 5, "c": "x"}, [1])
    row = df.select(has("v", "a"), has("v", "z"), text_at("v", "b"), text_at("v", "c")).collect()
    assert tuple(row[0]) == (True, False, None, "x")
    assert tuple(row[1]) == (False, False, None, None)


def test_blank_and_trim(spark):
    values = ["", " ", "\t\x0b\x0c\r", "  　\x85", "x", "​", "{", " {} "]
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    rows = df.select(is_blank("raw"), trimmed("raw")).collect()
    assert [r[0] for r in rows] == [v.strip() == "" for v in values]
    assert [r[1] for r in rows] == [v.strip() for v in values]


def test_line_numbers_over_many_splits(spark, put_file, tmp_path):
    texts = {}
    for name, n in (("b.jsonl", 5000), ("a.jsonl", 3000), ("c.jsonl", 3)):
        body = [json.dumps({"i": i, "pad": "x" * (i % 50)}) if i % 7 else " " * (i % 3) for i in range(n)]
        texts[name] = body
        put_file(f"d/{name}", "\r\n".join(body) + "\n")
    put_file("d/skip.txt", "{}")
    put_file("d/sub/x.jsonl", "{}\n")
    put_file("d/k=v/x.jsonl", "{}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = parse_lines(read_lines(spark, str(tmp_path / "d"))).cache()
        assert scan_lines(spark, str(tmp_path / "d")).rdd.getNumPartitions() > 10
        rows = df.select(F.element_at(F.split("file", "/"), -1), "file_ord", "line", "pos", "seq", "raw").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected, seq = [], 0
    for ord_, name in enumerate(sorted(texts)):
        pos = 0
        for number, text in enumerate(texts[name], 1):
            if text.strip():
                expected.append((name, ord_, number, pos, seq, text))
                pos, seq = pos + 1, seq + 1
    assert sorted(map(tuple, rows), key=lambda r: r[4]) == expected
    assert df.where("v is null").count() == 0


def test_line_index_does_not_shuffle_rows(spark, put_file):
    path = put_file("one.jsonl", "{}\n" * 50)
    plan = index_lines(scan_lines(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_given_order_and_repeats(spark, put_file):
    a, b = put_file("x a.jsonl", '{"n":1}\n\n{"n":2}\n'), put_file("b.jsonl", '{"n":3}\n')
    rows = read_lines(spark, [b, a, b]).orderBy("seq").select("raw", "line", "seq").collect()
    assert [tuple(r) for r in rows] == [('{"n":3}', 1, 0), ('{"n":1}', 1, 1), ('{"n":2}', 3, 2), ('{"n":3}', 1, 3)]


def test_missing_and_empty_input(spark, tmp_path, put_file):
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, str(tmp_path / "none"))
    (tmp_path / "e").mkdir()
    with pytest.raises(ValueError):
        scan_lines(spark, str(tmp_path / "e"))
    put_file("g/z.jsonl", "")
    assert file_list(scan_lines(spark, str(tmp_path / "g"))).count() == 1


def test_id_list(spark, put_file):
    path = put_file("ids.txt", " c \n\n\t\na\nc\n")
    rows = read_ids(spark, ["b", "a"], path).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [(0, "b"), (1, "a"), (2, "c"), (3, "a"), (4, "c")]
    with pytest.raises(ValueError):
        read_ids(spark)
    with pytest.raises(ValueError):
        read_ids(spark, [], put_file("no.txt", "\n \n"))


def test_names_are_no_patterns(spark, put_file, tmp_path):
    one = put_file("set [1]/x[1].jsonl", "1\n2\n")
    put_file("set [1]/a{b}*.jsonl", "3\n")
    put_file("set [1]/sub/y.jsonl", "4\n")
    assert [r.raw for r in read_lines(spark, one).orderBy("seq").collect()] == ["1", "2"]
    assert [r.raw for r in read_lines(spark, [one, one]).orderBy("seq").collect()] == ["1", "2", "1", "2"]
    assert [r.raw for r in read_lines(spark, str(tmp_path / "set [1]")).orderBy("seq").collect()] == ["3", "1", "2"]


def test_rewritten_folder_keeps_names(spark, put_file, tmp_path):
    names = ["Z.jsonl", "[b].jsonl", "a b.jsonl", "c[2]%20+.jsonl", "x=y é.jsonl"]
    for name in names:
        put_file(f"in/{name}", '\n{"custom_id":"%s","body":{}}\n{"custom_id":"last"}\n' % name)
    put_file("in/empty.jsonl", "")
    put_file("in/blank.jsonl", " \n\n")
    prepare_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), model="m")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == sorted([*names, "blank.jsonl", "empty.jsonl"])
    assert (tmp_path / "out/empty.jsonl").read_text() == (tmp_path / "out/blank.jsonl").read_text() == ""
    assert (tmp_path / "out/a b.jsonl").read_text() == '{"body":{"model":"m"},"custom_id":"a b.jsonl"}\n{"custom_id":"last"}\n'
    rows = parse_lines(read_lines(spark, str(tmp_path / "out"))).orderBy("seq")
    ids = [r[0] for r in rows.select(text_at("v", "custom_id")).collect()]
    assert [i for i in ids if i != "last"] == sorted(names)
    files = [r.file.rsplit("/", 1)[-1] for r in rows.select("file", "line").where("line = 1").collect()]
    assert files == sorted(names)
    prepare_directory(spark, str(tmp_path / "in"), str(tmp_path / "more"), added=["[1]", " 2 "])
    assert (tmp_path / "more/empty.jsonl").read_text() == "[1]\n2\n"
    assert (tmp_path / "more/Z.jsonl").read_text().splitlines()[1:] == ['{"custom_id":"last"}', "[1]", "2"]


def test_only_the_folder_itself_is_listed(spark, put_file, tmp_path):
    put_file("in/a.jsonl", "1\n")
    put_file("in/deep/b.jsonl", "2\n")
    put_file("in/.hidden.jsonl", "3\n")
    scan = scan_lines(spark, str(tmp_path / "in"))
    assert [r.raw for r in scan.collect()] == ["1"] and len(scan.inputFiles()) == 1


@pytest.mark.parametrize("opening, closing", [("[", "]"), ('{"a":', "}")])
def test_nesting_depth(spark, opening, closing):
    """127 levels pass and 128 do not, as in strict readers; brackets in texts are no levels."""
    def nested(levels, inner='"[[{"'):
        return opening * levels + inner + closing * levels

    texts = [nested(126), nested(127), nested(128), nested(200), '"' + "[" * 300 + '"', "[" + ",".join(["[1]"] * 300) + "]", '["\\\"",' + nested(127) + "]"]
    df = parse_lines(spark.createDataFrame([(t,) for t in texts], "raw string"))
    assert [r[0] for r in df.select(F.col("v").isNotNull()).collect()] == [True, True, False, False, True, True, False]
