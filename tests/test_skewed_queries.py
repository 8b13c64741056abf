"""The queries that join, with broadcasting off."""

import pytest

from tests import test_queries
from tests.test_queries import con  # noqa: F401

JOINING = [
    "inline_assets", "results_concat", "results_missing", "only_in_a", "match_results", "retry_set",
    "usage_totals", "batch_analytics_list", "resolve_models", "cost_estimate", "split_chunks",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_without_broadcasts(spark, con, name):  # noqa: F811
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_queries.test_query_agrees_with_sql(spark, con, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_asset_and_hot_id(spark, lines):
    """A third of all rows share one key on both sides of the lookup."""
    import json

    from reqframe.operators.compare import match_results
    from reqframe.operators.prepare import prepare
    from tests.test_compare import res_a
    from tests.test_prepare import image
    from tests.test_validate_stats import req

    paths = ["hot.png" if i % 3 == 0 else f"{i}.png" for i in range(120)]
    blobs = spark.createDataFrame([(p, bytearray(p.encode())) for p in set(paths)], "path string, bytes binary")
    rows = [json.loads(r.raw) for r in prepare(lines(*[req(str(i), [image(p)]) for i, p in enumerate(paths)]), blobs=blobs).collect()]
    assert len(rows) == 120
    assert all(r["body"]["messages"][0]["content"][0]["image_url"]["url"].startswith("data:image/png;base64,") for r in rows)
    ids = ["hot" if i % 3 == 0 else f"id{i}" for i in range(90)]
    matched = match_results(lines(*[req(i, "x") for i in ids]), lines(*[res_a(i, "y") for i in ids]))
    assert matched.count() == 30 * 30 + 60
