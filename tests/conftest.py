import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reqframe import build_session  # noqa: E402
from reqframe.functions.jsonlines import parse_lines  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Parsed lines from Python values (JSON-encoded) or raw text."""

    def make(*items, file="f.jsonl"):
        raws = [i if isinstance(i, str) else json.dumps(i, ensure_ascii=False) for i in items]
        rows = [(file, 0, i + 1, i, i, raw) for i, raw in enumerate(raws)]
        frame = spark.createDataFrame(
            rows, "file string, file_ord int, line bigint, pos bigint, seq bigint, raw string"
        )
        return parse_lines(frame)

    return make


@pytest.fixture
def put_file(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    return write
