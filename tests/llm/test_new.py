"""Suffix order, the conversation trie and aligned tokenizers against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from reqframe.llm import conversation_trie, ordered, suffix_dedup, token_alignment
from reqframe.llm.queries import tokenizer_files

SF = "/root/testdata/sf0.001"
TEXTS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# ---------------------------------------------------------------- op11

LENGTH = suffix_dedup.LENGTH


def windows(texts):
    return Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))


def cut(text, starts):
    gone = np.zeros(len(text) + 1, bool)
    for i in starts:
        gone[i : i + LENGTH] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone])) != 0)
    return bytes(b for b, g in zip(text, gone, strict=False) if not g), len(edges) // 2


def removed(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = windows(t for _, t in texts)
    out = []
    for d, t in texts:
        kept, spans = cut(t, [i for i in range(len(t) - LENGTH + 1) if seen[t[i : i + LENGTH]] > 1])
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed=4):
    rnd = random.Random(seed)

    def text(n):
        return " ".join("".join(rnd.choice("abcdefghié") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    base = [text(rnd.randint(60, 300)) for _ in range(12)]
    rows = []
    for i in range(60):
        b = rnd.choice(base)
        p = rnd.randint(0, len(b))
        middle = "" if i % 3 == 0 else b[p : p + rnd.randint(380, 800)]
        rows.append((i, b if i % 7 == 0 else f"{text(rnd.randint(0, 60))} {middle} {text(rnd.randint(0, 60))}"))
    hot = base[0][:450]
    rows += [(100 + i, f"{text(30)} {hot} {text(30)}") for i in range(40)]
    rows += [(200, None), (201, ""), (202, "a" * 1000), (203, "ab" * 300), (204, "abc" * 200), (None, base[0]), (3, base[0]), (3, base[0])]
    return rows + [(205, "x" * 399), (206, "x" * 399), (207, "y" * 400), (208, "y" * 400), (209, "z" * 400)]


@pytest.mark.parametrize("most", [3, 1024])
def test_passages_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = passages()
    frame = spark.createDataFrame(rows, TEXTS).repartition(5).selectExpr("*", "'k' AS tk", "1 AS spot", "2 AS bucket")
    got = suffix_dedup.removal_digests(frame)
    assert rows_of(got) == removed(rows)
    assert suffix_dedup.removal_digests(frame.limit(0)).count() == 0


def test_stretches_cut_long_texts(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1024)
    rows = [(i, t) for i, t in passages(9) if t and len(t) > 400]
    assert rows_of(suffix_dedup.removal_digests(spark.createDataFrame(rows, TEXTS))) == removed(rows)


def test_first_copies_stay(spark):
    rows = passages(5)
    texts, docs = suffix_dedup.deduplicated(spark.createDataFrame(rows, TEXTS), keep_first=True)
    key = lambda t: hashlib.md5(t).digest()
    first = {}
    for d, t in rows:
        t = (t or "").encode()
        first[t] = min(first.get(t, 2**63 - 1), 2**63 - 1 if d is None else d)
    order = sorted(first, key=lambda t: (first[t], key(t)))
    seen, want = set(), {}
    for t in order:
        late = []
        for i in range(len(t) - LENGTH + 1):
            w = t[i : i + LENGTH]
            late += [i] if w in seen else []
            seen.add(w)
        want[key(t)] = cut(t, late)[0]
    assert {bytes(r.tk): bytes(r.kept) for r in texts.collect()} == want
    assert docs.count() == len(rows)


def test_longest_previous_factors():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 40, 300):
        data = rnd.integers(97, 99, n).astype(np.uint8)
        levels, order, _ = suffix_dedup.suffix_order(data, 20)
        text = data.tobytes()
        assert [text[i : i + 20] for i in order] == sorted(text[i : i + 20] for i in range(n))
        lcp = np.zeros(n, np.int64)
        lcp[1:] = suffix_dedup.common_prefix(levels, data, order[1:], order[:-1])
        got = suffix_dedup.longest_previous_factors(order, lcp)
        for i, found in zip(order, got, strict=True):
            most = max((k for k in range(21) for j in range(i) if i + k <= n and text[i : i + k] == text[j : j + k]), default=0)
            assert min(found, n - i) == most


# ---------------------------------------------------------------- op12


def trie_nodes(rows):
    convs, seq, node = defaultdict(list), {}, defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), r or "", x or ""))
    convs = {c: [v[1:] for v in sorted(turns, key=lambda v: v[0])] for c, turns in convs.items()}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = tuple(convs.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(seq[c]) + 1):
            node[seq[c][:d]].append(c)
    kids, leaves, saved = Counter(v[:-1] for v in node if v), Counter(), Counter()
    for v, m in node.items():
        for d in range(len(v) + 1):
            leaves[v[:d]] += v not in kids
            saved[v[:d]] += (len(m) - 1) * len(v[-1][1].encode()) if v else 0
    out = []
    for v, m in node.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(v))))
        parent = min(node[v[:-1]]) if v else None
        out.append((min(m), len(v), parent, len(m), kids[v], leaves[v], saved[v], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=1):
    rnd = random.Random(seed)
    rows = [(c, t, "u", rnd.choice(["a", "b", "é"]) * rnd.randint(1, 2)) for c in [*range(60), 1000] for t in range(rnd.randint(0, 14) if c < 1000 else 60)]
    rows += [(c, t, "u", "deep" + "x" * (t == d)) for d, c in enumerate(range(2001, 2200, 5)) for t in range(d + 1)]  # a caterpillar
    rows += [(None, 1, "u", "x"), (7, 20, None, None), (12, 21, "", None), (500, 0, "u", "a"), (503, 0, "u", "zz"), (9, None, "u", "first")]
    return rows


@pytest.mark.parametrize("block", [3, 1024])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    monkeypatch.setattr(conversation_trie, "PIECE", block)
    monkeypatch.setattr(conversation_trie, "CHUNK", block)
    rows = conversations()
    frame = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "1 AS s", "2 AS d", "'x' AS k1")
    assert rows_of(conversation_trie.prefix_trie(frame)) == trie_nodes(rows)


def test_trie_of_little(spark):
    for rows in ([], [(7, 1, "u", "x")], [(5, 1, "u", "x")], [(None, 1, "u", "x")]):
        assert rows_of(conversation_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie_nodes(rows)
    # repeated rows of a turn are turns of their own, in a fixed order
    twice = [(5, 1, "u", "x")] * 2 + [(5, 0, "u", "y")]
    assert rows_of(conversation_trie.prefix_trie(spark.createDataFrame(twice, TURNS))) == trie_nodes(twice)


def test_trie_equals_sql(spark):
    db = duckdb.connect()
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    columns = conversation_trie.prefix_trie(frame).columns
    got = conversation_trie.prefix_trie(frame).collect()
    want = db.execute(conversation_trie.ORACLE).df()[columns]
    want = [tuple(None if pd.isna(v) else v if isinstance(v, str) else int(v) for v in r) for r in want.astype(object).itertuples(index=False)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_search_needs_few_steps_and_rounds(spark):
    """A comb of depth 200: rounds stay near the logarithm of the sequences, not their number."""
    rows = [(c * 5, t, "u", "t" if t < d else f"end{c}") for c, d in enumerate(range(200)) for t in range(9 + d + 1)]
    turns, convs = conversation_trie.rebuilt(spark.createDataFrame(rows, TURNS))
    assert convs.count() == 200
    seen = []
    build = conversation_trie.Trie.build
    try:
        conversation_trie.Trie.build = lambda self: seen.append(build(self)) or seen[-1]
        got = conversation_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()
    finally:
        conversation_trie.Trie.build = build
    assert sorted(map(tuple, got), key=str) == trie_nodes(rows)
    assert seen[0].rounds <= 40


def test_running_sums_cross_partitions(spark):
    rows = [(1, i, i * i) for i in range(500)] + [(k, 0, k) for k in range(2, 40)] + [(99, i, -i) for i in range(90)]
    frame = spark.createDataFrame(rows, "k long, at long, v long").selectExpr("*", "1L AS row").repartition(6)
    from pyspark.sql import functions as F

    got = {(r.k, r.at): (r.v, r.row) for r in ordered.running(frame, "k", [F.col("at")], ["v", "row"], "test").collect()}
    total, want = Counter(), {}
    for k, at, v in rows:
        total[k] += v
        want[k, at] = (total[k], at + 1)
    assert got == want


# ---------------------------------------------------------------- op13


def plain_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def bytes_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    docs, count = [], Counter()
    for doc_id, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            tokens_a = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
            tokens_b = [bytes_b(i) for i in b]
            if b"".join(tokens_a) != (" " + text).encode() or b"".join(tokens_b) != (" " + text).encode():
                a, b = [], []
            ends_a = {sum(map(len, tokens_a[: k + 1])): k for k in range(len(a))}
            ends_b = {sum(map(len, tokens_b[: k + 1])): k for k in range(len(b))}
            i = j = 0
            for end in sorted(ends_a.keys() & ends_b.keys()):
                x, y = ends_a[end], ends_b[end]
                links.append((a[x], b[y]))
                groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
                i, j = x + 1, y + 1
        count.update(links)
        docs.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, a, b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(count[x] == most[x[1]] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(count[x] for x in links), digest))
    return sorted(out, key=str)


def test_alignment_equals_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(d, t[:600] if t else t) for d, t in table] + [
        (9001, None), (9002, ""), (None, "plain words"), (9003, "plain words"), (9003, "plain words"), (9004, "a ▁ b"), (9005, " "), (9006, "\n\n\t x"),
        (9007, "<s> </s> <unk> <|endoftext|> <0x41>"), (9008, "日本語 naïve 🙂‍ x\x00y"), (9009, " " * 3000 + "end"), (9010, "word" * 2000), (9011, "é ﬁ   　"),
    ]
    frame = spark.createDataFrame(rows, TEXTS).repartition(4).selectExpr("*", "'a' AS text_key", "1 AS pair", "2 AS n_a")
    files = tokenizer_files()
    got = token_alignment.alignments(frame, files)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got.select(names)) == plain_alignment(rows)
    assert token_alignment.alignments(frame.limit(0), files).count() == 0


def test_linked_pairs_are_bounded_by_the_vocabularies(spark):
    files = tokenizer_files()
    aligner = token_alignment.Aligner(files)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = token_alignment.pair_counts(token_alignment.aligned_texts(frame, files)).collect()
    assert all(aligner.bytes_a[r.id_a].endswith(aligner.bytes_b[r.id_b]) or aligner.bytes_b[r.id_b].endswith(aligner.bytes_a[r.id_a]) for r in pairs)
    assert 0 < len(pairs) < aligner.most_pairs() < 1_000_000
