import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from reqframe.plans.oracles import ORACLES  # noqa: E402
from reqframe.plans.queries import REGISTRY  # noqa: E402
from tests.conftest import SF  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, con, name):
    assert check.compare(spark, con, SF, name) == ""


def test_pages_fetched_twice_from_one_address(spark, tmp_path):
    import duckdb

    rows = [(1, "http://x/a.jpg", "<p>one</p>"), (2, "http://x/a.jpg", "<p>two</p>"), (3, "http://x/b", "<p>one</p>")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    pages = duckdb.connect()
    pages.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    pages.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    for name in ("inline_assets", "multimodal_stats"):
        assert check.compare(spark, pages, str(tmp_path), name) == ""


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert REGISTRY.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry_does_without_the_optional_package(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert alone.queries() == REGISTRY and alone.oracle_sql() == ORACLES


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "estimated_cost" in df.columns
