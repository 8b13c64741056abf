"""Two tokenizers aligned over a corpus: where their tokens end together, and which ids pair up best.

Exact-text deduplication: documents are shuffled by their full text, each distinct text is tokenized and
aligned once, pair counts are weighted by the text's copies, and the measures are joined back to doc_ids.

A text is encoded as space + text by a byte-level BPE (A, a file of ranks) and as the text by a
sentencepiece model (B, which adds the space itself); strings of special tokens are plain text. Byte
offsets where a token of A and a token of B both end cut the tokens into groups; the two tokens that end
there are a link. One of two linked tokens is a suffix of the other, as both end at the same byte. So the
distinct pairs of ids are bounded by the two vocabularies alone (``most_pairs``), whatever the corpus:
their counts are sent to all tasks.

Null and empty texts, and texts whose joined bytes of A or B are not space + text, have no tokens:
zeros and an empty ``groups``. Repeated rows are copies like any other and each has its row; a null
doc_id stays null. Very long texts are encoded whole, one at a time. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import saved

#: Pairs added up in a task before they are handed on.
HELD = 1 << 20
SLICE = 256
_LONG_SPACE = re.compile(r"\s{1000}")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Definitions:
    """The files of both tokenizers, as they travel to tasks."""

    def __init__(self, ranks: str | Path, definition: str | Path, pieces: str | Path, pattern: str):
        self.ranks = Path(ranks).read_bytes()
        self.definition = Path(definition).read_text("utf-8")
        self.pieces = Path(pieces).read_bytes()
        self.pattern = pattern


class Aligner:
    """Both tokenizers with the bytes of all their tokens."""

    def __init__(self, files: Definitions):
        import sentencepiece
        import tiktoken
        import tokenizers

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files.ranks.splitlines())}
        self.fast = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = tokenizers.Tokenizer.from_str(files.definition)
        self.plain.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        of_a = dict(map(reversed, ranks.items()))
        self.bytes_a = [of_a.get(i, b"") for i in range(max(of_a) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        a, b = len(self.bytes_a), len(self.bytes_b)
        # an id of A followed by "," or "|", an id of B followed by "," or ";"
        self.shown = [f"{i}{end}".encode() for ids, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(ids)]
        self.base = 2 * a

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def most_pairs(self) -> int:
        """How many pairs of ids can ever be linked: those of which one is a suffix of the other."""
        return sum(
            others[x[k:]]
            for these, others in ((self.bytes_a, Counter(self.bytes_b)), (self.bytes_b, Counter(self.bytes_a)))
            for x in these
            for k in range(len(x))
        )

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B for each text."""
        # the fast splitter keeps a stack as deep as a run of white space is long
        a = [
            np.array(self.plain.encode(" " + x, add_special_tokens=False).ids, np.int64)
            if _LONG_SPACE.search(x)
            else np.array(self.fast.encode_ordinary(" " + x), np.int64)
            for x in texts
        ]
        b = self.pieces.encode(texts, num_threads=1)
        return [(x, np.array(y, np.int64)) for x, y in zip(a, b, strict=True)]

    def align(self, text: str, a: np.ndarray, b: np.ndarray):
        """``(pair codes, n_a, n_b, sha256 of the groups)``, or None where the bytes differ."""
        target = b" " + text.encode()
        if b"".join(map(self.bytes_b.__getitem__, b.tolist())) != target or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != target:
            return None
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        near = np.searchsorted(end_b, end_a)
        last_a = end_b[near] == end_a  # both end at the end of the text, so near is always inside
        at_a, at_b = np.flatnonzero(last_a), near[last_a]
        # tokens in order of groups, those of A first
        before_a = np.concatenate([[0], at_a + 1])  # tokens of A in the groups before
        before_b = np.concatenate([[0], at_b + 1])
        group_a = np.searchsorted(at_a, np.arange(len(a)))
        group_b = np.searchsorted(at_b, np.arange(len(b)))
        codes = np.empty(len(a) + len(b), np.int64)
        last_b = np.zeros(len(b), bool)
        last_b[at_b] = True
        codes[np.arange(len(a)) + before_b[group_a]] = a + last_a * (self.base // 2)
        codes[np.arange(len(b)) + before_a[group_b + 1]] = self.base + b + last_b * len(self.bytes_b)
        shown = b"".join(map(self.shown.__getitem__, codes.tolist()))[:-1]
        return (a[at_a] << 32) | b[at_b], len(a), len(b), hashlib.sha256(shown).hexdigest()


def _aligner(files) -> Aligner:
    # kept on a library's module, which lives as long as the worker process
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_reqframe_aligner", {})
    if kept.get("for") != (mark := hashlib.sha256(files.value.ranks + files.value.pieces).digest()):
        kept.update({"for": mark, "is": Aligner(files.value)})
    return kept["is"]


ALIGNED = "text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, pairs binary"


def _packed(codes: np.ndarray, counts: np.ndarray, squeeze) -> bytes:
    """Codes and counts, each split into planes of equal bytes."""
    return squeeze.compress(codes.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(packed: bytes, n: int, opener) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(opener.decompress(packed, max_output_size=12 * n), np.uint8)
    codes = np.frombuffer(planes[: 8 * n].reshape(8, n).T.tobytes(), "<u8")
    return codes, np.frombuffer(planes[8 * n :].reshape(4, n).T.tobytes(), "<u4")


def _aligned(files):
    def run(batches):
        aligner, squeeze = _aligner(files), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column("text").to_pylist()
                rows = []
                for text, (a, b) in zip(texts, aligner.encode(texts), strict=True):
                    if (got := aligner.align(text, a, b)) is None:
                        rows.append((0, 0, 0, "", 0, b""))
                        continue
                    pairs, n_a, n_b, digest = got
                    codes, counts = np.unique(pairs, return_counts=True)
                    rows.append((n_a, n_b, len(pairs), digest, len(codes), _packed(codes, counts, squeeze)))
                n_a, n_b, links, digests, n, packed = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_key"), part.column("copies"), *(pa.array(x, pa.int64()) for x in (n_a, n_b, links, links)),
                     pa.array(digests, pa.string()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())],
                    names=["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "pairs"],
                )

    return run


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_codes, all_counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(all_codes, kind="stable")
    all_codes = all_codes[order]
    first = np.flatnonzero(np.diff(all_codes, prepend=all_codes[:1] ^ np.uint64(1)))
    return all_codes[first], np.add.reduceat(all_counts[order], first)


def _pair_counts(batches):
    """Counts of pairs, weighted by copies and added up within the task."""
    opener, codes, counts, held = zstandard.ZstdDecompressor(), [], [], 0

    def out():
        x, n = _summed(codes, counts)
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        for n, copies, packed in zip(*(batch.column(k).to_pylist() for k in ("n_pairs", "copies", "pairs")), strict=True):
            if not n:
                continue
            x, times = _unpacked(packed, n, opener)
            codes.append(x)
            counts.append(times.astype(np.int64) * copies)
            held += n
            if held > HELD:
                x, times = _summed(codes, counts)
                codes[:], counts[:], held = [x], [times], 0
    if codes:
        yield out()


def _measured(pairs):
    def run(batches):
        codes, counts, best = pairs.value
        opener = zstandard.ZstdDecompressor()
        keep = ["text_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        for batch in batches:
            n_best, count_sum = [], []
            for n, packed in zip(batch.column("n_pairs").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                if not n:
                    n_best.append(0)
                    count_sum.append(0)
                    continue
                x, times = _unpacked(packed, n, opener)
                at, times = np.searchsorted(codes, x), times.astype(np.int64)
                n_best.append(int(times[best[at]].sum()))
                count_sum.append(int((times * counts[at]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                names=[*keep, "n_best", "count_sum"],
            )

    return run


def _key():
    return F.unhex(F.sha2(F.col("text"), 256))


def aligned_texts(documents: DataFrame, files: Definitions) -> DataFrame:
    """Each distinct text that is neither null nor empty, aligned: ``ALIGNED``, a written table.

    ``pairs`` holds the distinct linked pairs (id of A << 32 | id of B) and how often each occurs.
    """
    texts = documents.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies")).withColumn("text_key", _key())
    sent = documents.sparkSession.sparkContext.broadcast(files)
    return saved(distinct.mapInArrow(_aligned(sent), ALIGNED), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``id_a, id_b, n``: links over the whole corpus, copies counted; at most ``most_pairs`` rows."""
    summed = aligned.select("n_pairs", "copies", "pairs").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return summed.select(F.shiftright("pair", 32).alias("id_a"), F.expr("pair & 4294967295").alias("id_b"), "n")


def alignments(documents: DataFrame, files: Definitions) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row a document."""
    aligned = aligned_texts(documents, files)
    got = pair_counts(aligned).toArrow()
    a, b, n = (got.column(k).to_numpy() for k in ("id_a", "id_b", "n"))
    most = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
    np.maximum.at(most, b, n)
    codes = ((a << 32) | b).astype(np.uint64)
    order = np.argsort(codes)
    sent = documents.sparkSession.sparkContext.broadcast((codes[order], n[order], (n == most[b])[order]))
    measures = aligned.drop("copies").mapInArrow(
        _measured(sent), "text_key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.select("doc_id", _key().alias("text_key")).join(measures, "text_key", "left")
    numbers = [F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return rows.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
