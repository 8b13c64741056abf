"""Token files coded by a static range asymmetric numeral system (rANS).

A text is tokenized, an end id appended, and the ids of all documents, in ascending order of doc_id,
are written as blocks and read back.

File format: a folder of Parquet files with one row per block, and beside it a folder with the shared
frequency table (``symbol, frequency``; frequencies sum to ``2**SCALE``). A block holds whole
documents, about ``BLOCK`` tokens; a longer document has a block of its own. Its columns:

* ``part, block``: place in the order; ``first``: tokens of the part before it; ``n_tokens``;
* ``doc_ids, lengths``: its documents and their numbers of tokens;
* ``payload``: for every ``STEPS`` steps a checkpoint (position in the stream as uint32, one uint64
  state for each lane), then the stream of uint32 words, all little-endian;
* ``checkpoints``: how many there are; ``checksum``: crc32 of the payload.

``LANES`` coders are interleaved: token ``t`` belongs to lane ``t % LANES``, the last step is filled
with the commonest symbol. Coding and decoding run over all lanes of many blocks at once, and
decoding starts at every checkpoint at the same time.
"""

from __future__ import annotations

import gc
import json
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqframe.llm.common import saved

END = 2
SCALE = 18
LANES = 32
STEPS = 256
BLOCK = 32_768
GROUP = 1 << 21  # tokens coded together
TEXT_BYTES = 4 << 20  # text that is cut together: its different words are looked up once
LOW = np.uint64(1 << 31)

BLOCK_SCHEMA = (
    "part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<int>, "
    "checkpoints int, checksum long, payload binary"
)


# ---------------------------------------------------------------- tokenizing


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level models write each byte (a fixed rule)."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _kinds() -> np.ndarray:
    """The kind of each byte: 1 ASCII letter, 2 ASCII mark but ``'`` and ``_``, 4 line end, 8 space, 16 other white space, 0 all else."""
    kinds = np.zeros(256, np.uint8)
    for k, found in ((1, string.ascii_letters), (2, string.punctuation), (0, "'_"), (16, "\t\v\f\r\x1c\x1d\x1e\x1f"), (8, " "), (4, "\n")):
        kinds[list(found.encode())] = k
    return kinds


_KINDS = _kinds()


class _Pieces(dict):
    """Ids (uint32 bytes) of pieces of text, found when a piece is first asked for and kept.

    ``mark`` is the space that stands before each piece, as the model writes it, or empty.
    """

    _SHAPE = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]*)(\n?)([^\W\d_]*)([!-&(-/:-@\[-^`{-~]*)")

    def __init__(self, tokenizer, mark: str, heads: _Pieces | None = None):
        self.tokenizer, self.tokenize, self.mark, self.old = tokenizer, tokenizer.model.tokenize, mark, {}
        self.heads = self if heads is None else heads  # pieces without a space before them
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._word(piece) if piece.isalpha() else self._cut(piece)
        self[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word of letters alone, straight from the model, as the splitter would hand it over."""
        if not word.isascii():
            word = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(self.mark + word)]).tobytes()

    def _cut(self, piece: str) -> bytes:
        """A piece of letters, ASCII marks, a line end, letters and marks is cut there; others go through the whole tokenizer."""
        shape = self._SHAPE.fullmatch(piece)
        if shape is not None:
            a, b, c, d, e = shape.groups()
            # some numerals count as letters in a Python pattern
            if (a + d).isalpha():
                heads = self.heads
                return self[a] + heads[b] + heads[c] + (heads[d] if d else b"") + heads[e]
        return array("I", self.tokenizer.encode(" " + piece if self.mark else piece, add_special_tokens=False).ids).tobytes()

    def renew(self) -> None:
        """What has not been asked for since the last call is let go."""
        self.old = dict(self)
        self.clear()


class Encoder:
    """Texts to ids (uint32) with a tokenizer given as JSON.

    A byte-level BPE splits text by a pattern that always breaks before a space after a character that
    is no white space, around a single line end, and between a letter and a mark. There texts are cut,
    and each piece is tokenized once and kept, up to ``2 * WORDS`` of them; other tokenizers get texts whole, and so do
    texts that hold the string of an added token, which becomes that token's id as in the library.
    """

    WORDS = 250_000

    def __init__(self, definition: str):
        import tokenizers

        # kept on the library's module, which lives as long as the worker process
        store = tokenizers.__dict__.setdefault("_reqframe_words", {})
        if definition not in store:
            store.clear()
            tokenizer = tokenizers.Tokenizer.from_str(definition)
            heads = _Pieces(tokenizer, "")
            store[definition] = (tokenizer, _Pieces(tokenizer, _byte_letters()[32], heads), heads)
        # words: after a space; heads: without one
        self.tokenizer, self.words, self.heads = store[definition]
        spec = json.loads(definition)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None
            and spec["model"]["type"] == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and all(x.get("special") for x in spec.get("added_tokens", []))
        )
        self.added = [x["content"] for x in spec.get("added_tokens", [])]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32."""
        if not self.by_word:
            return self._whole(texts)
        together = "".join(texts)
        if any(map(together.__contains__, self.added)):
            holds = [any(map(text.__contains__, self.added)) for text in texts]
            if any(holds):
                whole = iter(self._whole([text for text, held in zip(texts, holds, strict=True) if held]))
                parts = iter(self.encode([text for text, held in zip(texts, holds, strict=True) if not held]))
                return [next(whole if held else parts) for held in holds]
        for known in (self.words, self.heads):
            if len(known) > self.WORDS:
                known.renew()
        return self._by_piece(texts)

    @staticmethod
    def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where pieces begin in UTF-8 texts that lie one after the other, and the end.

        Both sides of a cut are ASCII, but for a space after any other character, which may be a wide space.
        """
        kind = _KINDS[data]
        before, here = kind[:-1], kind[1:]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = ((here == 8) & (before < 4)) | ((before | here) == 3)
        ends = np.flatnonzero(kind[1:-1] == 4) + 1
        ends = ends[(kind[ends - 1] - 1 < 2) & (kind[ends + 1] - 1 < 2)]
        cut[ends] = cut[ends + 1] = True
        cut[starts] = True
        return np.flatnonzero(cut)

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        """Texts are cut together, each different piece is looked up once, and its ids are copied to all its places."""
        held = pa.array(texts, pa.large_string())
        _, offsets, data = held.buffers()
        starts = np.frombuffer(offsets, np.int64, len(texts) + 1)
        if not starts[-1]:
            return [b""] * len(texts)
        at = self._cuts(np.frombuffer(data, np.uint8, starts[-1]), starts)
        coded = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data).dictionary_encode()
        pieces, words, heads = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words, self.heads
        known = pa.array([words[p[1:]] if p[0] == " " else heads[p] for p in pieces], pa.large_binary())
        _, offsets, ids = known.take(coded.indices).buffers()
        ends = np.frombuffer(offsets, np.int64, len(at))[np.searchsorted(at, starts)].tolist()
        out = [ids[a:b].to_pybytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        # a cut after a wide space may be none of the pattern's
        wide = [k for k, p in enumerate(pieces) if p[-1] > "\x7f" and p[-1].isspace()]
        if wide:
            places = at[:-1][np.isin(coded.indices.to_numpy(), wide)]
            again = np.unique(np.searchsorted(starts, places, side="right") - 1).tolist()
            for k, found in zip(again, self._whole([texts[k] for k in again]), strict=True):
                out[k] = found
        return out


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``TEXT_BYTES`` of text, or of one longer text."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy())
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(sizes, TEXT_BYTES + (sizes[at - 1] if at else 0), side="right")))
        yield batch.slice(at, to - at)
        at = to


def _tokenized(definition, end: int):
    def run(batches):
        encoder = Encoder(definition.value)
        # words are millions of objects without cycles, which the collector would visit over and over
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from tokenize(batches, encoder)
        finally:
            if collecting:
                gc.enable()

    def tokenize(batches, encoder):
        squeeze = zstandard.ZstdCompressor(level=1)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in _parts(batch):
                ids = [x + tail for x in encoder.encode([x or "" for x in part.column("text").to_pylist()])]
                planes = [np.frombuffer(x, np.uint8).reshape(-1, 4).T.tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([squeeze.compress(x) for x in planes], pa.binary())],
                    names=["doc_id", "tie", "n_tokens", "ids"],
                )

    return run


def _ids(packed: bytes, count: int, opener) -> np.ndarray:
    planes = opener.decompress(packed, max_output_size=4 * count)
    return np.frombuffer(np.frombuffer(planes, np.uint8).reshape(4, -1).T.tobytes(), "<u4")


# ---------------------------------------------------------------- coding


class Table:
    """Frequencies of symbols that sum to ``2**SCALE``, every counted symbol at least 1."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(frequency)[:-1]]).astype(np.uint64)
        self.pad = int(frequency.argmax()) if len(frequency) else 0

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Integer frequencies in proportion to counts."""
        used = np.flatnonzero(counts)
        out = np.zeros(len(counts), np.int64)
        whole = 1 << SCALE
        if len(used) > whole // 2:
            raise ValueError(f"{len(used)} symbols are too many for {SCALE} bits")
        if len(used):
            out[used] = 1 + np.floor(counts[used] / counts[used].sum() * (whole - len(used))).astype(np.int64)
            out[used[counts[used].argmax()]] += whole - out.sum()
        return out

    def symbols(self) -> np.ndarray:
        """The symbol of every slot."""
        return np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[tuple[int, bytes]]:
    """Number of checkpoints and payload of each block of ids."""
    steps = np.array([-(-len(b) // LANES) for b in blocks])
    order = np.argsort(-steps, kind="stable")
    most = int(steps.max())
    ids = np.full((most, len(blocks), LANES), table.pad, np.uint32)
    for place, k in enumerate(order):
        flat = np.full(steps[k] * LANES, table.pad, np.uint32)
        flat[: len(blocks[k])] = blocks[k]
        ids[: steps[k], place] = flat.reshape(-1, LANES)
    active = np.searchsorted(-steps[order], -np.arange(most), side="left")  # blocks with more steps than s
    words, sent = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, bool)
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    points: dict[int, np.ndarray] = {}
    scale, half, shift = np.uint64(SCALE), np.uint64(32), np.uint64(63 - SCALE)
    for s in range(most - 1, -1, -1):
        k = active[s]
        symbol, x = ids[s, :k], state[:k]
        f = table.frequency[symbol]
        out = x >= (f << shift)
        words[s, :k] = x.astype(np.uint32)
        sent[s, :k] = out
        x = np.where(out, x >> half, x)
        q = x // f
        state[:k] = (q << scale) + (x - q * f) + table.below[symbol]
        if s % STEPS == 0:
            points[s] = state[:k].copy()
    results: list = [None] * len(blocks)
    for place, k in enumerate(order):
        used = sent[: steps[k], place]
        at = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
        marks = range(0, int(steps[k]), STEPS)
        head = b"".join(np.array([at[s]], "<u4").tobytes() + points[s][place].astype("<u8").tobytes() for s in marks)
        results[k] = (len(marks), head + words[: steps[k], place][used].astype("<u4").tobytes())
    return results


def decode_blocks(blocks: list[tuple[int, int, bytes]], table: Table, symbols: np.ndarray) -> list[np.ndarray]:
    """Ids of blocks ``(tokens, checkpoints, payload)``; all stretches between checkpoints run together."""
    mark = 4 + 8 * LANES
    state, position, steps, base, owner = [], [], [], [], []
    streams, offset = [], 0
    for k, (count, marks, payload) in enumerate(blocks):
        total = -(-count // LANES)
        for m in range(marks):
            head = payload[m * mark : (m + 1) * mark]
            position.append(offset + int(np.frombuffer(head[:4], "<u4")[0]))
            state.append(np.frombuffer(head[4:], "<u8"))
            steps.append(min(STEPS, total - m * STEPS))
            owner.append(k)
        stream = np.frombuffer(payload, "<u4", offset=marks * mark)
        streams.append(stream)
        offset += len(stream)
        base.append(total)
    if not state:
        return [np.empty(0, np.uint32) for _ in blocks]
    words = np.concatenate([*streams, np.zeros(LANES, np.uint32)]).astype(np.uint64)
    steps, state, position = np.array(steps), np.stack(state).astype(np.uint64), np.array(position)
    order = np.argsort(-steps, kind="stable")
    x_all, at_all = state[order], position[order]
    most = int(steps.max())
    active = np.searchsorted(-steps[order], -np.arange(most), side="left")
    out = np.empty((len(steps), most, LANES), np.uint32)
    mask, scale, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for s in range(most):
        k = active[s]
        x, at = x_all[:k], at_all[:k]
        slot = x & mask
        symbol = symbols[slot]
        out[:k, s] = symbol
        x = table.frequency[symbol] * (x >> scale) + slot - table.below[symbol]
        need = x < LOW
        rank = np.cumsum(need, axis=1)
        index = at[:, None] + rank - 1
        x_all[:k] = np.where(need, (x << half) | words[np.where(need, index, 0)], x)
        at_all[:k] = at + rank[:, -1]
    pieces: list[list[np.ndarray]] = [[] for _ in blocks]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    for j, k in enumerate(owner):
        pieces[k].append(out[place[j], : steps[j]].reshape(-1))
    return [np.concatenate(p)[: b[0]] if p else np.empty(0, np.uint32) for p, b in zip(pieces, blocks, strict=True)]


def _groups(rows: Iterator, steps_of) -> Iterator[list]:
    """Blocks that are coded together: bounded by their padded size."""
    group, most = [], 0
    for row in rows:
        n = steps_of(row)
        if group and max(most, n) * (len(group) + 1) * LANES > GROUP:
            yield group
            group, most = [], 0
        group.append(row)
        most = max(most, n)
    if group:
        yield group


def _written(frequency):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        table, opener = Table(frequency.value), zstandard.ZstdDecompressor()

        def blocks():
            ids, docs, lengths, size = [], [], [], 0
            for batch in batches:
                for doc, count, packed in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "n_tokens", "ids")), strict=True):
                    if size and size + count > BLOCK:
                        yield np.concatenate(ids), docs, lengths
                        ids, docs, lengths, size = [], [], [], 0
                    ids.append(_ids(packed, count, opener))
                    docs.append(doc)
                    lengths.append(count)
                    size += count
            if size:
                yield np.concatenate(ids), docs, lengths

        first, number = 0, 0
        for group in _groups(blocks(), lambda b: -(-len(b[0]) // LANES)):
            rows = []
            for (ids, docs, lengths), (marks, payload) in zip(group, encode_blocks([g[0] for g in group], table), strict=True):
                rows.append((part, number, first, len(ids), docs, lengths, marks, zlib.crc32(payload), payload))
                first += len(ids)
                number += 1
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.binary()]
            names = ["part", "block", "first", "n_tokens", "doc_ids", "lengths", "checkpoints", "checksum", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _read(frequency):
    def run(batches):
        table = Table(frequency.value)
        symbols = table.symbols()

        def rows():
            for batch in batches:
                for at in range(batch.num_rows):
                    yield batch.slice(at, 1).to_pylist()[0]

        for group in _groups(rows(), lambda r: -(-r["n_tokens"] // LANES)):
            for r in group:
                if zlib.crc32(r["payload"]) != r["checksum"]:
                    raise ValueError(f"block {r['part']}/{r['block']} is damaged")
            decoded = decode_blocks([(r["n_tokens"], r["checkpoints"], r["payload"]) for r in group], table, symbols)
            out = []
            for r, ids in zip(group, decoded, strict=True):
                at = 0
                for doc, n in zip(r["doc_ids"], r["lengths"], strict=True):
                    out.append((r["part"], doc, r["first"] + at, n, ids[at : at + n].astype("<u4").tobytes()))
                    at += n
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "doc_id", "offset", "n_tokens", "ids"]
            for at in range(0, len(out), 256):
                piece = zip(*out[at : at + 256], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(piece, kinds, strict=True)], names=names)

    return run


def write_tokens(documents: DataFrame, definition: str, end: int = END) -> tuple[DataFrame, DataFrame]:
    """Tokenize and write ``documents``; returns the saved blocks and the saved frequency table.

    ``definition`` is a tokenizer file's JSON. The tokenized texts are kept once in the shared folder,
    counted for the frequency table, then sorted by ranges of doc_id and coded. Null doc_ids come first;
    rows of one doc_id are ordered by a hash of their text.
    """
    context = documents.sparkSession.sparkContext
    # Spark's 10,000 rows (64 MB) would be held several times over in each task
    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BYTES)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text")
    )
    tokens = saved(
        docs.mapInArrow(_tokenized(context.broadcast(definition), end), "doc_id long, tie long, n_tokens long, ids binary"), "tokens"
    )

    def count(batches):
        total, opener = np.zeros(0, np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, packed = part.column("n_tokens").to_pylist(), part.column("ids").to_pylist()
                ids = np.concatenate([_ids(x, n, opener) for n, x in zip(sizes, packed, strict=True)])
                got = np.bincount(ids, minlength=len(total))
                got[: len(total)] += total
                total = got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["symbol", "n"])

    # one row for each id of the vocabulary at most
    counts = tokens.select("n_tokens", "ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()
    symbol, n = (counts.column(k).to_numpy() for k in ("symbol", "n"))
    total = np.zeros(int(symbol.max()) + 1 if len(symbol) else 1, np.int64)
    total[symbol] = n
    frequency = Table.scaled(total)
    used = np.flatnonzero(frequency)
    spark = documents.sparkSession
    frequencies = saved(
        spark.createDataFrame(pa.table({"symbol": used, "frequency": frequency[used]})), "frequencies"
    )
    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = saved(ordered.mapInArrow(_written(context.broadcast(frequency)), BLOCK_SCHEMA), "blocks")
    return blocks, frequencies


def read_tokens(blocks: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Documents of a token file: ``doc_id, start, n_tokens, ids`` (little-endian uint32).

    ``start`` counts the ids of all documents before it. A damaged block stops the job.
    """
    context = blocks.sparkSession.sparkContext
    got = frequencies.toArrow()
    symbol = got.column("symbol").to_numpy()
    frequency = np.zeros(int(symbol.max()) + 1 if len(symbol) else 1, np.int64)
    frequency[symbol] = got.column("frequency").to_numpy()
    rows = blocks.mapInArrow(_read(context.broadcast(frequency)), "part int, doc_id long, offset long, n_tokens long, ids binary")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # one row for each task that wrote, so it can be sent to all
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(starts), F.col("part") == F.col("of")).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids")


def token_digests(documents: DataFrame, definition: str) -> DataFrame:
    """Write, read back and sum up: ``doc_id, start, n_tokens, ids_crc32``, a row per row of ``documents``.

    Null and empty texts have the end id only. Null doc_ids are written first, repeated rows each; other
    columns are ignored. An empty table gives no rows. A task holds one group of blocks, or the block of
    one very long text.
    """
    tokens = read_tokens(*write_tokens(documents, definition))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
