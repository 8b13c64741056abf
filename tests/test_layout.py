import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reqframe.operators import layout
from reqframe.operators.layout import (
    chunk_summary,
    chunks,
    concat_results,
    merge,
    merge_summary,
    missing_outputs,
    rank_results,
    renumber,
    require_lines,
    results_page,
    sample,
)
from reqframe.operators.ranks import Ranked
from reqframe.sources import sinks
from reqframe.sources.lines import read_lines
from reqframe.sources.sinks import write_chunks, write_lines, write_ordered
from tests.test_compare import err, res_a


def texts(df, *order):
    return [r.raw for r in df.orderBy(*order).select("raw").collect()]


def test_split_and_merge_give_the_same_lines(spark, put_file, tmp_path):
    body = [f'{{"i": {i}}}  ' for i in range(2503)]
    source = read_lines(spark, put_file("big.one.jsonl", "\n\n".join(body) + "\n"))
    split = chunks(source)
    assert [tuple(r) for r in chunk_summary(split).orderBy("chunk_name").collect()] == [
        ("big.one-001", 1000), ("big.one-002", 1000), ("big.one-003", 503),
    ]
    write_chunks(split, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("*.jsonl"))
    assert [p.name for p in parts] == ["big.one-001.jsonl", "big.one-002.jsonl", "big.one-003.jsonl"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == [p.name for p in parts]
    assert [line for p in parts for line in p.read_text().splitlines()] == body
    assert texts(read_lines(spark, [str(p) for p in parts]), "seq") == body
    assert texts(read_lines(spark, str(tmp_path / "out")), "seq") == body


@pytest.mark.parametrize("block", [3, 4096])
def test_parts_are_cut_by_bytes(spark, put_file, tmp_path, monkeypatch, block):
    """Lines of very different sizes: no part is above the bound unless it is one line, and their order stays."""
    monkeypatch.setattr(sinks, "_BLOCK", block)
    rnd = random.Random(block)
    body = [str(i) + "x" * rnd.choice([0, 5, 50, 120, 700]) for i in range(400)]
    source = read_lines(spark, put_file("s.jsonl", "\n".join(body)))
    write_chunks(chunks(source, 250), str(tmp_path / "o"), part_bytes=300)
    parts = sorted(p for p in (tmp_path / "o").iterdir() if p.suffix == ".jsonl")
    assert {p.name.split(".")[0] for p in parts} == {"s-001", "s-002"} and parts[0].name == "s-001.00000.jsonl"
    assert [line for p in parts for line in p.read_text().splitlines()] == body
    for p in parts:
        assert p.stat().st_size <= 300 or len(p.read_text().splitlines()) == 1
    assert sum(p.stat().st_size > 100 for p in parts) > len(parts) / 2


def test_a_failed_job_leaves_nothing(spark, put_file, tmp_path):
    source = read_lines(spark, put_file("s.jsonl", "\n".join(map(str, range(100)))))
    bad = source.withColumn("raw", F.when(F.col("pos") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("raw")))
    with pytest.raises(Exception, match="lost"):
        write_chunks(chunks(bad, 10), str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()
    write_chunks(chunks(source, 60), str(tmp_path / "o"))
    with pytest.raises(FileExistsError):
        write_chunks(chunks(source, 60), str(tmp_path / "o"))
    assert len(list((tmp_path / "o").glob("s-*.jsonl"))) == 2


def test_a_repeated_task_leaves_one_file(spark, put_file, tmp_path):
    """What a lost attempt has written stays out of the committed folder, so each part has one file."""
    source = read_lines(spark, put_file("s.jsonl", "\n".join(map(str, range(100)))))
    folder = tmp_path / "o"
    finished = sinks._Folder.finished
    seen = []

    def watched(self, at):
        stray = Path(at) / "_temporary" / "0" / "attempt"
        stray.mkdir(parents=True)
        (stray / "part-00000.txt").write_text("half a li")
        seen.append(at)
        return finished(self, at)

    try:
        sinks._Folder.finished = watched
        write_chunks(chunks(source, 30), str(folder))
    finally:
        sinks._Folder.finished = finished
    assert len(seen) == 4
    assert [x for p in sorted(folder.glob("*.jsonl")) for x in p.read_text().split()] == [str(i) for i in range(100)]
    assert {p.name for p in folder.iterdir() if not p.name.startswith(".")} == {f"s-00{i}.jsonl" for i in range(1, 5)}


def test_chunk_names_and_errors(lines):
    df = chunks(lines(*[str(i) for i in range(1200)]), 1).where("pos in (0, 99, 1199)")
    assert [r.chunk_name for r in df.orderBy("pos").collect()] == ["f-001", "f-100", "f-1200"]
    with pytest.raises(ValueError):
        chunks(df, 0)
    with pytest.raises(ValueError):
        require_lines(df.where("false"))


def test_merge_keeps_order_and_repeats(lines):
    merged = renumber(merge(lines("1", "2"), lines("{bad", "1"), lines("2")))
    assert texts(merged, "merged_seq") == ["1", "2", "{bad", "1", "2"]
    assert sorted(r.merged_seq for r in merged.collect()) == [0, 1, 2, 3, 4]
    assert tuple(merge_summary(merged).first()) == (1, 5)


def test_ordered_sink(spark, put_file, tmp_path):
    body = [str(i) for i in range(1000)]
    lines = read_lines(spark, put_file("o.jsonl", "\n".join(body)))
    write_ordered(lines.orderBy(F.rand(1)), str(tmp_path / "out"), part_bytes=900)
    parts = sorted((tmp_path / "out").glob("part*.txt"))
    assert len(parts) > 4 and all(p.stat().st_size <= 900 for p in parts)
    assert [x for p in parts for x in p.read_text().split()] == body
    write_lines(lines, str(tmp_path / "plain"))
    got = [x for p in (tmp_path / "plain").glob("part-*") for x in p.read_text().split()]
    assert sorted(got) == sorted(body)


@pytest.mark.parametrize("k", [1, 7, 400, 999, 1000, 5000])
@pytest.mark.parametrize("accuracy", [3, 20_000])
def test_sample_size(spark, monkeypatch, k, accuracy):
    """Whatever the sketch says, a large sample is the one of a plain order."""
    monkeypatch.setattr(layout, "_ACCURACY", accuracy)
    df = spark.range(1000).withColumnRenamed("id", "line")
    small = [r.line for r in sample(df, k, "line", seed=3, top_k=10_000).collect()]
    large = [r.line for r in sample(df, k, "line", seed=3, top_k=0).collect()]
    assert sorted(small) == sorted(large)
    assert len(set(small)) == len(small) == min(k, 1000)
    if k == 400:
        other = {r.line for r in sample(df, k, "line", seed=4).collect()}
        assert other != set(small) and 300 < sum(small) / len(small) < 700


@pytest.mark.parametrize("bounds", [(1 << 59, (1 << 60) - 1), (-1, 5)])
def test_sample_survives_wrong_bounds(spark, monkeypatch, bounds):
    monkeypatch.setattr(layout, "_lot_bounds", lambda *_: bounds)
    df = spark.range(300).withColumnRenamed("id", "line")
    assert sorted(map(tuple, sample(df, 50, "line", top_k=0).collect())) == sorted(map(tuple, sample(df, 50, "line").collect()))


def test_sample_errors(lines):
    with pytest.raises(ValueError):
        sample(lines("1"), 0, "line")
    nothing = lines("1").where("false")
    assert sample(nothing, 3, "line").count() == chunks(nothing).count() == 0
    for refused in (lambda: sample(nothing, 3, "line", required=True), lambda: chunks(nothing, required=True)):
        with pytest.raises(ValueError, match="no lines"):
            refused()
    assert sample(lines("1"), 3, "line", required=True).count() == 1


def test_concat(spark, lines):
    results = lines("x1", "x2").withColumn("batch_id", F.lit("x")).unionByName(lines("y1").withColumn("batch_id", F.lit("y")))
    ids = spark.createDataFrame([(0, "y"), (1, "x"), (2, "y"), (3, "n")], "ordinal bigint, id string")
    assert texts(concat_results(results, ids), "ordinal", "line") == ["y1", "x1", "x2", "y1"]
    batches = spark.createDataFrame([("x", "f"), ("y", "g"), ("n", None)], "id string, output_file_id string")
    assert [r.id for r in missing_outputs(ids, batches).collect()] == ["n"]


@pytest.mark.parametrize("ranges", [1, 3])
def test_page(lines, tmp_path, spark, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    df = lines(res_a("a", "1"), err("b"), res_a("c", "2"), res_a("d", "3"), err("e"))
    try:
        ranked = rank_results(df, str(tmp_path / "r"))
        nothing = rank_results(df.where("false"), str(tmp_path / "n"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)

    def page(*a, of=ranked):
        rows = results_page(of, *a).orderBy("pos").collect()
        return [r.pos for r in rows], {(r.incomplete, r.last_line) for r in rows}

    assert page(1, 2) == ([1, 2], {(True, 3)})
    assert page(3, 9) == ([3, 4], {(False, 5)})
    assert page(9, 9) == ([], set())
    assert page(1, 1, "completed") == ([2], {(True, 2)})
    assert page(0, 2, "failed") == ([1, 4], {(False, 2)})
    assert page(0, 9, "completed", of=nothing) == ([], set())
    assert results_page(ranked, 0, 5).columns == [*df.columns, "incomplete", "last_line"]


def touched_files(df):
    return {r[0] for r in df.select(F.input_file_name()).collect()}


def test_pages_read_the_ranges_they_touch(spark, tmp_path):
    df = spark.range(0, 10_000, 1, 7).select(F.col("id"), (F.col("id") * 7919 % 10_007).alias("k"), F.lit("x").alias("text"))
    ranked = Ranked.write(df, [F.col("k").desc(), "id"], str(tmp_path / "r"), {"odd": F.col("id") % 2 == 1}, ranges=20)
    plain = [r.id for r in df.orderBy(F.col("k").desc(), "id").collect()]
    again = Ranked(spark, str(tmp_path / "r"))
    for skip, limit in ((0, 5), (4_990, 20), (9_995, 50), (10_000, 5)):
        for of, want in ((None, plain), ("odd", [i for i in plain if i % 2])):
            rows = again.page(skip, limit, of).orderBy("position").collect()
            assert [r.id for r in rows] == want[skip : skip + limit]
            assert [r.position for r in rows] == list(range(skip, skip + len(rows)))
            plan = again.page(skip, limit, of)._jdf.queryExecution().executedPlan().toString()
            assert "TakeOrderedAndProject" not in plan
            assert not want[skip:] or "_range" in plan.split("PartitionFilters")[1]
            assert len(touched_files(again.page(skip, limit, of))) <= 2
    assert [r.id for r in ranked.listing().orderBy("position").collect()] == plain
    assert ranked.total() == 10_000 and ranked.total("odd") == 5_000


def test_lines_stay_where_they_are_while_parts_are_dealt(spark, tmp_path, monkeypatch):
    lines = spark.range(9000).selectExpr("if(id % 3 = 0, 'a', 'b') AS name", "id AS position", "cast(10 + id % 7 AS bigint) AS size")

    def parts(working, part_bytes):
        placed = sinks.sized_parts(lines, "name", "position", "size", str(tmp_path / working), part_bytes)
        return placed._jdf.queryExecution().executedPlan().toString(), sorted(map(tuple, placed.collect()))

    for part_bytes in (1 << 20, 600):
        monkeypatch.setattr(sinks, "_SENT", 1 << 20)
        sent, found = parts(f"sent-{part_bytes}", part_bytes)
        monkeypatch.setattr(sinks, "_SENT", -1)
        shuffled, same = parts(f"shuffled-{part_bytes}", part_bytes)
        assert found == same and len(found) == 9000
        assert "SortMergeJoin" not in sent and "SortMergeJoin" in shuffled
        assert len({p for *_, p in found}) > 2 or part_bytes > 600
