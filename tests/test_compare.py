import pytest
from pyspark.sql import functions as F

from reqframe.operators import joins
from reqframe.operators.compare import (
    compare_runs,
    diff_detail,
    diff_summary,
    input_warnings,
    match_results,
    only_in_a,
    retry_set,
)
from reqframe.operators.joins import join_on
from reqframe.operators.results import outcome_counts, result_columns, structured
from tests.test_validate_stats import req

ABSENT = object()


def res_a(cid, content=ABSENT, **usage):
    message = {} if content is ABSENT else {"content": content}
    return {"custom_id": cid, "response": {"body": {"choices": [{"message": message}], "usage": usage}}}


def res_b(cid, content, **usage):
    return {"custom_id": cid, "response_body": {"choices": [{"message": {"content": content}}], "usage": usage}}


def err(cid, error="boom"):
    return {"custom_id": cid, "error": error}


def summary(a, b, **kw):
    return diff_summary(a, b, **kw).first().asDict()


def test_simple_difference(lines):
    got = summary(lines(res_a("q7", "42 km")), lines(res_a("q7", "43 km")))
    assert got == dict(
        entries_a=1, entries_b=1, common=1, identical=0, different=1, only_in_a=0, only_in_b=0,
        parse_errors_a=0, missing_id_a=0, duplicates_a=0, parse_errors_b=0, missing_id_b=0, duplicates_b=0,
    )


@pytest.mark.parametrize(
    "one, two, same",
    [
        (res_a("a", None), res_a("a"), False),
        (res_a("a"), res_a("a", ""), True),
        (res_a("a", "null"), res_a("a", None), True),
        (res_a("a", [{"x": 1, "b": 2}]), res_a("a", [{"b": 2, "x": 1}]), True),
        (res_b("a", "x"), res_a("a", "x"), True),
        (res_b("a", "x"), res_b("a", "y"), False),
        (err("a"), res_a("a", ""), True),
    ],
)
def test_content_rules(lines, one, two, same):
    assert summary(lines(one), lines(two))["identical"] == int(same)


def test_strict_shape(lines):
    got = summary(lines(res_b("a", "x")), lines(res_b("a", "y")), strict_shape_a=True)
    assert (got["identical"], got["different"]) == (1, 0)


def test_warnings_repeats_and_sides(lines):
    a = lines(res_a("a", "1"), "{bad", res_a("b", "x"), res_a("a", "2"), {"custom_id": 5}, {"x": 1}, "7")
    b = lines(res_a("a", "2"), res_a("c", "x"), res_a("c", "y"))
    got = summary(a, b)
    assert got == dict(
        entries_a=2, entries_b=2, common=1, identical=1, different=0, only_in_a=1, only_in_b=1,
        parse_errors_a=1, missing_id_a=3, duplicates_a=1, parse_errors_b=0, missing_id_b=0, duplicates_b=1,
    )
    assert tuple(input_warnings(a).first()) == (1, 3, 1)
    assert sorted(map(tuple, diff_detail(a, b).collect())) == [("a", "identical"), ("b", "only_in_a"), ("c", "only_in_b")]
    assert [r[0] for r in only_in_a(a, b).collect()] == ["b"]
    same = summary(a, a)
    assert same["different"] == 0 and same["entries_a"] == same["common"] + same["only_in_a"] == 2


def test_diff_is_one_shuffle_per_level(lines):
    plan = diff_summary(lines(res_a("a", "1")), lines(res_a("a", "1")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_result_columns(lines):
    df = lines(res_a("a", "x", prompt_tokens=3, completion_tokens=4, total_tokens=7), res_b("b", None, prompt_tokens=1),
               err("c"), err("d", ""), {"custom_id": "e", "response_body": {}, "response": {"body": {"choices": []}}})
    rows = result_columns(df).orderBy("line").collect()
    got = [(r.custom_id, r.content, r.content_kind, r.prompt_tokens, r.total_tokens, r.is_result, r.is_error) for r in rows]
    assert got == [
        ("a", "x", "STRING", 3, 7, True, False),
        ("b", "null", "VOID", 1, None, True, False),
        ("c", None, None, None, None, False, True),
        ("d", None, None, None, None, False, False),
        ("e", None, None, None, None, False, False),
    ]
    assert tuple(outcome_counts(df).first()) == (2, 1, 2)


def test_structured(lines):
    good = '{"title":"Tide","checked":true}'
    df = structured(lines(res_a("a", good), res_a("b", "{oops"), res_a("c"), res_a("d", "[]")), "title string, checked boolean")
    rows = df.orderBy("line").collect()
    assert rows[0].data.asDict() == {"title": "Tide", "checked": True}
    assert [r.bad_content for r in rows[:3]] == [False, True, True]
    assert rows[1].data is None


def test_compare_runs(lines):
    requests = lines(req("a", "p1"), req("b", "p2"), req("z", "p3"))
    one = lines(res_a("a", "x", prompt_tokens=1, completion_tokens=2), res_a("b"), res_a("q", "no request"))
    two = lines(res_a("a", None), res_a("z", "only here"), res_a("b", "null"))
    rows = compare_runs(requests, {"one": one, "two": two}).orderBy("custom_id").collect()
    assert [(r.custom_id, r.prompt, r.one_content, r.two_content) for r in rows] == [
        ("a", "p1", "x", "(no response)"),
        ("b", "p2", "(no response)", "null"),
        ("q", None, "no request", "(no response)"),
    ]
    assert (rows[0].one_prompt_tokens, rows[0].one_completion_tokens, rows[0].two_prompt_tokens) == (1, 2, None)


def test_match_and_retry(lines):
    requests = lines(req("a", "1"), req("b", "2"), req("c", "3"), req("a", "4"), {"x": 1}, req("d", "5"))
    results = lines(err("a"), res_a("b", "ok"), err("b"), err("c"), res_a("c", "late"), err("zz"))
    rows = match_results(requests, results).orderBy("request_line", "result_line").collect()
    assert [(r.custom_id, r.request_line, r.result_line) for r in rows] == [
        ("a", 1, 1), ("b", 2, 2), ("b", 2, 3), ("c", 3, 4), ("c", 3, 5), ("a", 4, 1), (None, 5, None), ("d", 6, None),
    ]
    assert [(r.custom_id, r.line) for r in retry_set(requests, results).orderBy("line").collect()] == [("a", 1), ("a", 4)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("unique", [True, False])
def test_join_equals_plain_join(spark, monkeypatch, how, unique):
    left_key = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 'hot2' ELSE concat('k', id) END")
    left = spark.range(3000).select(F.col("id").alias("l"), left_key.alias("key"))
    right_key = "concat('k', id)" if unique else "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE concat('k', id % 400) END"
    right = spark.range(900).select(F.col("id").alias("r"), F.expr(right_key).alias("key"))
    if unique:
        right = right.unionAll(spark.sql("select 9999L r, 'hot' key"))
    plain = left.join(right, "key", how)
    ours = join_on(left, right, "key", how, right_unique=unique)
    assert ours.columns == plain.columns
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
    assert ours.count() == plain.count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_sides_as_read_are_broadcast_on_an_estimate(spark, tmp_path):
    """Catalyst takes built texts and generated rows for small; no job counts them before the join."""
    left = spark.range(1000).withColumnRenamed("id", "key")
    tall = spark.range(200).select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n"), (F.col("id") * 5 + F.col("n")).alias("key"))
    joined = join_on(left, tall, "key", right_unique=True)
    assert joins.plan_bytes(tall) <= joins.broadcast_limit(spark)
    assert "BroadcastHashJoin" not in plan_of(joined) and joined.count() == 1000
    tall.write.parquet(str(tmp_path / "t"))
    assert "BroadcastHashJoin" in plan_of(join_on(left, spark.read.parquet(str(tmp_path / "t")), "key"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_adaptive_execution_splits_a_hot_key(spark, how):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.expr("CASE WHEN id % 2 = 0 THEN -1 ELSE id END")
        left = spark.range(0, 40_000, 1, 8).select(key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        right = spark.range(0, 3000).select((F.col("id") - 1).alias("key"), F.explode(F.array(F.lit(1))).alias("r"))
        joined = join_on(left, right, "key", how, right_unique=True)
        rows = joined.collect()
        assert len(rows) == (21_500 - 1 if how == "inner" else 40_000)
        assert "skew=true" in plan_of(joined)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_compared_contents_are_in_no_aggregation(lines):
    requests = lines(req("a", "p1"))
    plan = plan_of(compare_runs(requests, {"one": lines(res_a("a", "x")), "two": lines(res_a("a", "y"))}))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert not any("content" in line for line in plan.splitlines() if "HashAggregate" in line)


def test_diff_aggregates_by_hash(spark, lines):
    a, b = lines(res_a("x", "same"), res_a("y", "one")), lines(res_a("x", "same"), res_a("y", "two"))
    assert "SortAggregate" not in plan_of(diff_detail(a, b))
    assert sorted(map(tuple, diff_detail(a, b).collect())) == [("x", "identical"), ("y", "different")]
