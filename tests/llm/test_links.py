"""Vectors, quotations, components and the pipeline."""

import math
import time

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from reqframe.llm import decontaminate, embedding_dedup, near_dedup, quotation, secrets, toxicity
from reqframe.llm.common import components

SF = "/root/testdata/sf0.001"


def brute_links(rows, least=0.9):
    good = {}
    for key, v in rows:
        if key is not None and v is not None and None not in v and len(v) == 4 and all(math.isfinite(x) for x in v) and any(v):
            good[key] = np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v))
    label = {k: k for k, _ in rows}
    count = dict.fromkeys(label, 0)
    pairs = [(a, b) for a in good for b in good if a != b and float(good[a] @ good[b]) >= least]
    for a, _ in pairs:
        count[a] += 1
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return sorted((k, count[k], label[k], k == label[k]) for k in label if k is not None)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(9, 4))
    rows = [(i, (centres[i % 9] + rng.normal(size=4) * (0.02 if i % 3 else 0.5)).tolist()) for i in range(150)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 0.0, 0.0]), (204, [1.0, 2.0])]
    rows += [(205, [math.inf, 0.0, 0.0, 1.0]), (206, rows[0][1]), (207, [x * 1e150 for x in rows[0][1]]), (208, [x * 3 for x in rows[1][1]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS tile")
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == brute_links(rows)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_vectors_of_each_length_link_among_themselves(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(np.repeat(rng.normal(size=(10, 4)), 3, axis=0) + rng.normal(size=(30, 4)) * 0.02)]
    short = [(100 + i, v.tolist()) for i, v in enumerate(np.repeat(rng.normal(size=(5, 3)), 2, axis=0))]
    stray = [(200, [1.0] * 9)]
    frame = spark.createDataFrame(rows + short + stray, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(frame).collect()}
    want = {k: (n, c, kept) for k, n, c, kept in brute_links(rows)}
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    assert sum(n for n, _, _ in want.values()) > 0
    assert {k: v for k, v in got.items() if k < 100} == want
    assert {k: v[0] for k, v in got.items() if 100 <= k < 200} == {k: sum(cos(v, w) >= 0.9 for j, w in short if j != k) for k, v in short}
    assert all(got[100 + 2 * k + 1][1] == got[100 + 2 * k][1] for k in range(5))
    assert got[200] == (0, 200, True)


def test_repeated_ids_name_no_node(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (None, [1.0, 0.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0])]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 2, 4, True), (4, 2, 4, True),
    ]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


@pytest.mark.parametrize("tile", [4, 64])
def test_tiles_that_meet_lose_no_link(spark, monkeypatch, tile):
    """Vectors along few axes: most cells are apart, and every link is found all the same."""
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "VISITORS", 4)
    rng = np.random.default_rng(8)
    angle = rng.uniform(0, 2 * np.pi, 300)
    x = np.column_stack([np.cos(angle), np.sin(angle), rng.normal(size=300) * 0.1, rng.normal(size=300) * 0.05])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.995).collect())
    assert got == brute_links(rows, 0.995)


def shuffled(spark):
    """Bytes that all tasks so far have shuffled."""
    time.sleep(0.5)  # executors' sums are brought up to date at intervals, as tasks end
    spark.range(1).count()
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    seen = sc.statusStore().executorList(False)
    return sum(seen.apply(k).totalShuffleWrite() for k in range(seen.size()))


@pytest.mark.parametrize("meetings", [3, 20_000])
def test_tiles_that_all_meet_are_not_shuffled_to_each_other(spark, monkeypatch, meetings):
    """Some 64 tiles without structure along few axes: what is shuffled follows the table, not the meetings."""
    monkeypatch.setattr(embedding_dedup, "TILE", 8)
    monkeypatch.setattr(embedding_dedup, "VISITORS", 2)
    monkeypatch.setattr(embedding_dedup, "MEETINGS", meetings, raising=False)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(40, 64)), 10, axis=0) + rng.normal(size=(400, 64)) * 0.15
    x[::2] = x[::2].astype(np.float32)  # single precision holds these, and not the others
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert near.sum() > 2000 and near.argmax(axis=1).max() > 350
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    before = shuffled(spark)
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(frame).collect())
    after = shuffled(spark)
    assert [r[1] for r in got] == (near.sum(axis=1) - 1).tolist()
    assert [r[2] for r in got] == [i // 10 * 10 for i in range(400)]
    assert 0 < after - before < 6 * x.nbytes


def test_vectors_in_single_precision_are_read_back_exactly():
    rows = np.array([[1.0, 0.5, -2.0], [0.1, 1e300, 1e-300], [np.float32(0.1), 2.0**100, 0.0], [1e39, 1.0, 1.0]])
    parts = [embedding_dedup._coded(r) for r in rows]
    assert [len(p) for p in parts] == [12, 24, 12, 24]
    assert (embedding_dedup._decoded(parts, 3) == rows).all()


def test_vectors_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    p = table.toPandas().sort_values("vec_id")
    x = np.stack(p.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = embedding_dedup.near_vectors(table).toPandas().sort_values("vec_id")
    assert got.n_links.tolist() == links.tolist()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert {k: v for k, v in got.items() if k != v} == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shown(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("null" if pd.isna(v) else v if isinstance(v, str) else str(int(v)) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("span", [2, 512])
def test_quotations_equal_sql(spark, monkeypatch, span):
    monkeypatch.setattr(quotation, "SPAN", span)
    rows = [
        (1, 0, "user", "Hello there\nsecond line\n\nA paragraph of its own"),
        (1, 1, "assistant", "> hello   THERE\n> second line\nfine, thanks"),
        (1, 2, "user", ">> Hello there\n>> second line\n> fine, thanks\nok"),
        (1, 5, "user", "> A paragraph of its own\nyes\n\n> nobody said this"),
        (1, 9, "user", "  > ok\n\t>> fine, thanks\n>\n"),
        (2, 3, "user", "> fine, thanks"),
        (2, 3, "system", "same turn"),
        (2, 4, "user", None), (2, 5, "user", ""), (None, 1, "user", "> x"), (3, None, "user", "y > z"),
    ]
    spec = "conv_id long, turn long, role string, text string"
    got = quotation.reply_order(spark.createDataFrame(rows, spec).selectExpr("*", "'c' AS row", "1 AS stretch")).toPandas()
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    db = duckdb.connect()
    db.register("conversations", conversations)
    want = db.sql(quotation.ORACLE).df()
    same_turn = ["reply_order"]  # rows of one turn are ordered by a hash here
    assert shown(got.drop(columns=same_turn)) == shown(want.drop(columns=same_turn))
    ordered = got[got.conv_id == 1].sort_values("turn")
    assert ordered.parent_turn.fillna(-1).astype(int).tolist() == [-1, 0, 1, 0, 2]
    assert ordered.reply_order.astype(int).tolist() == [0, 1, 2, 3, 4]
    assert ordered.text.tolist()[1:3] == ["fine, thanks", "ok"]
    assert quotation.reply_order(spark.createDataFrame([], spec)).count() == 0


def covered(pairs, seed=5):
    """Tokens of an item marked by plain greedy tiling of equal windows: the longest run of a diagonal first."""
    pairs, used_i, used_j, total = set(pairs), set(), set(), 0
    while True:
        best = None
        for i, j in sorted(pairs):
            if (i - 1, j - 1) in pairs:
                continue
            n = 0
            while (i + n, j + n) in pairs:
                n += 1
            if best is None or n > best[0]:
                best = (n, i, j)
        if best is None:
            return total
        n, i, j = best
        total += n + seed - 1
        used_i |= set(range(i, i + n + seed - 1))
        used_j |= set(range(j, j + n + seed - 1))
        pairs = {(i, j) for i, j in pairs if not used_i & set(range(i, i + seed)) and not used_j & set(range(j, j + seed))}


def test_pipeline_equals_its_parts(spark):
    """Each decision recomputed plainly: scores row by row, all pairs of sets, all windows, all spans."""
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "benchmark decontamination", "secret scans", "packing"]
    model = toxicity.train(docs, labels)
    left = {r.doc_id: r.text for r in docs.collect() if model.score(r.text)[0] < toxicity.THRESHOLD}
    hashes = near_dedup.WordHashes()
    sets = {d: set(near_dedup.shingles(t, hashes).tolist()) for d, t in left.items()}
    label = {d: d for d in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(len(pairs)):
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    left = {d: t for d, t in left.items() if label[d] == d}
    items = [decontaminate.tokens(r.text) for r in bench.collect()]

    def bad(text):
        words = decontaminate.tokens(text)
        at = {}
        for j in range(len(words) - 4):
            at.setdefault(tuple(words[j : j + 5]), []).append(j)
        for item in items:
            hits = [(i, j) for i in range(len(item) - 4) for j in at.get(tuple(item[i : i + 5]), [])]
            if covered(hits) >= 0.5 * len(item):
                return True
        return False

    scanner = secrets.Scanner()
    want = {d: len(secrets.redact(t, scanner.spans(t)).encode()) for d, t in left.items() if not bad(t)}
    got = {r.doc_id: r.length for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_decide_by_row(spark, tmp_path):
    """Repeated rows, rows without an id, and different texts under one id."""
    item = " ".join(f"b{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [
        (5, one), (5, one), (5, one), (7, one + " end"), (None, one),  # one group
        (7, two), (None, three), (None, three), (None, three + " end"),
        (3, None), (3, ""), (None, ""), (9, f"{one[::-1]} {item}"), (None, item), (9, "clean words only, and nothing more"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "'k' AS _row_key", "1 AS label", "2 AS length")
    rows = [(*r, "k", 1, 2) for r in rows]
    order = lambda rows: sorted((tuple(r) for r in rows), key=str)
    got = corpus_pipeline.keep_one_of_each(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = order(got.collect())
    near = [r for r in kept if r[1] and r[1].startswith("z")]
    assert len(near) == 1 and near[0] in rows[6:9]
    assert [r for r in kept if r not in near] == order([rows[0], rows[5], *rows[9:]])
    clean = corpus_pipeline.drop_benchmark_passages(spark, docs, str(tmp_path))
    assert order(clean.collect()) == order([*rows[:12], rows[14]])


def test_empty_documents_go_through_all_stages(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_awkward_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, clashing names: every stage keeps the columns and the clean rows."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    long_text = " ".join(f"calm{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(None, None, None, None, None), (1, None, "en", "s", None), (1, "", None, None, 0), (1, "", None, None, 0), (2, long_text, "de", "s", len(long_text)), (3, "x", "fr", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'s' AS score", "'b' AS bucket", "1 AS _row_key")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and got.count() == len(rows)
    assert sorted(r.length for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()) == [0, 0, 0, 0, 1, len(long_text)]


def test_stages_give_python_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "a few words", "en", "web", 11)], columns)
    wide = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 3000) AS text")

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.keep_one_of_each, corpus_pipeline.drop_benchmark_passages, corpus_pipeline.redact_secrets):
        spark.conf.unset(key)
        try:
            stage(spark, docs, SF)
            got = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
        finally:
            spark.conf.unset(key)
        assert sum(got) == 6000 and max(got) * 3000 < 6 << 20, stage
