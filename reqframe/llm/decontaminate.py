"""Benchmark decontamination by greedy string tiling.

Tokens are maximal runs of word characters, lower-cased; in scripts written without spaces (Chinese,
Japanese, Thai, Lao, Khmer, Burmese, Tibetan) each character is a token of its own. A token is its 64-bit
hash. Windows of ``SEED`` tokens are the seeds (an item of fewer tokens is one window of its whole length):
a Karp-Rabin pass rolls over every text, and a bitmap of ``BITS`` bits of the benchmark's fingerprints, the same
size whatever the benchmark's, says which windows may be seeds. Of a text only the stretches that such windows cover leave
the task; its distinct fingerprints are joined with those of the items.

For each text and item that share enough seeds the stretches are tiled greedily: the longest common run of unmarked
tokens is searched by Karp-Rabin fingerprints at falling lengths, held against a table of the unmarked windows of the item;
it is marked on both sides, and the search goes on until no run of ``SEED`` tokens is left. Windows of text and item are
never paired, so repetitive texts cost no more than others. Tiles may lie in any order, so reordered passages
count. An item whose marked share reaches ``COVERAGE`` contaminates the document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import saved

SEED = 5
COVERAGE = 0.5
#: Bits of the map of fingerprints that is sent to the tasks (16 MB).
BITS = 1 << 27

_WORD = re.compile(r"\w+")
#: Letters of scripts that put no spaces between words.
_UNSPACED = (
    "\u0e01-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u19e0-\u19ff\ua9e0-\ua9ff\uaa60-\uaa7f\u3005-\u3007\u3031-\u3035\u303b\u303c"
    "\u3041-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff"
)
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_MIXED = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
_BASE = 0x9E3779B97F4A7C15


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def tokens(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    return (_WORD if text.isascii() or not _ANY_UNSPACED.search(text) else _MIXED).findall(text)


def fingerprints(words: list[str], codes: dict, size: int = SEED) -> np.ndarray:
    """Karp-Rabin fingerprints of all windows of ``size`` tokens (polynomial modulo 2**64)."""
    return _rolled(_coded(words, codes), size)


def _coded(words: list[str], codes: dict) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def _rolled(code: np.ndarray, size: int) -> np.ndarray:
    if len(code) < size:
        return np.empty(0, np.uint64)
    count = len(code) - size + 1
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + code[k : k + count]
    return out


def _size(count: int) -> int:
    """Tokens of the seeds of an item."""
    return min(SEED, count)


def _coded_rows(batch, codes: dict):
    for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        words = tokens(text)
        if words:
            yield key, _coded(words, codes)


def _bit(prints: np.ndarray) -> np.ndarray:
    return (prints * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(32)) % np.uint64(BITS)


def _item_rows(batches):
    """Items as token hashes, with their distinct seeds and how often each occurs."""
    codes = _Codes()
    for batch in batches:
        out = []
        for key, code in _coded_rows(batch, codes):
            prints, times = np.unique(_rolled(code, _size(len(code))), return_counts=True)
            out.append((key, code.tobytes(), len(code), _size(len(code)), prints.view(np.int64).tolist(), times.tolist()))
        if out:
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "item", "n_tokens", "size", "prints", "times"])


def _bitmap(items: DataFrame) -> np.ndarray:
    """The bits of all seeds' fingerprints, packed; put together by words of 64 bits, of which there are ``BITS / 64`` at most."""

    def words(batches):
        for batch in batches:
            for prints in batch.column("prints").to_pylist():
                bits = _bit(np.array(prints, np.int64).view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((bits >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))], names=["word", "bits"]
                )

    got = items.select("prints").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _hit_rows(known, sizes: list[int]):
    """Texts with windows that may be seeds: their distinct fingerprints, and the token hashes that such windows cover.

    Between stretches of ``codes`` stands one entry that ``apart`` marks; it matches nothing.
    """

    def run(batches):
        codes = _Codes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for key, code in _coded_rows(batch.slice(at, 256), codes):
                    covered, prints = np.zeros(len(code), bool), []
                    for size in sizes:
                        rolled = _rolled(code, size)
                        bits = _bit(rolled)
                        hit = np.flatnonzero((known.value[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1))
                        for k in range(size):
                            covered[hit + k] = True
                        prints.append(rolled[hit])
                    prints = np.unique(np.concatenate(prints))
                    if not len(prints):
                        continue
                    ends = np.flatnonzero(covered[:-1] & ~covered[1:]) + 1
                    covered[ends] = True
                    apart = np.zeros(len(code), bool)
                    apart[ends] = True
                    out.append((key, prints.view(np.int64).tolist(), code[covered].tobytes(), np.packbits(apart[covered]).tobytes()))
                if out:
                    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
                    columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "prints", "codes", "apart"])

    return run


class _Prints:
    """Fingerprints of windows of any length of a sequence, from one prefix sum."""

    def __init__(self, code: np.ndarray):
        n = len(code)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        self.up = np.cumprod(power)
        power[1:] = np.uint64(pow(_BASE, -1, 2**64))
        self.down = np.cumprod(power)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(code * self.up[:n], out=self.total[1:])

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.total[start + size] - self.total[start]) * self.down[start]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of windows without a marked token."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(total[size:] == total[:-size]) if size <= len(marked) else np.zeros(0, np.int64)


def tiles_of(item: np.ndarray, text: np.ndarray, apart: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item position, text position, length)`` of two sequences of token hashes.

    Longest first; ties by item position, then text position. ``apart`` are entries of the text that match nothing.
    """
    in_item, in_text = _Prints(item), _Prints(text)
    used_item, used_text = np.zeros(len(item), bool), apart.copy()
    tiles = []

    def shared(size: int):
        """Unmarked windows of both that have a fingerprint in common."""
        i, j = _free(used_item, size), _free(used_text, size)
        x, y = in_item.of(i, size), in_text.of(j, size)
        # the item's windows are the table, the shorter side
        known = np.unique(x)
        if not len(known) or not len(y):
            return i[:0], j[:0], x[:0], y[:0]
        j_in = known[np.minimum(np.searchsorted(known, y), len(known) - 1)] == y
        i_in = np.isin(x, y[j_in])
        return i[i_in], j[j_in], x[i_in], y[j_in]

    most = min(len(item), len(text))
    while True:
        # the longest length of which there is a common unmarked run; every shorter one has some, too
        low, high = least - 1, most
        while low < high:
            size = (low + high + 1) // 2
            low, high = (size, high) if len(shared(size)[0]) else (low, size - 1)
        if low < least:
            return tiles
        i, j, x, y = shared(low)
        order = np.argsort(y, kind="stable")
        keys, begin, times = np.unique(y[order], return_index=True, return_counts=True)
        starts = dict(zip(keys.tolist(), begin.tolist(), strict=True))
        ends = dict(zip(keys.tolist(), (begin + times).tolist(), strict=True))
        at_text = j[order].tolist()
        for p, key in zip(i.tolist(), x.tolist(), strict=True):
            if used_item[p : p + low].any():
                continue
            # places that are passed over stay marked, so each is looked at once
            k = starts[key]
            while k < ends[key] and (used_text[(q := at_text[k])] or used_text[q : q + low].any()):
                k += 1
            starts[key] = k
            if k < ends[key]:
                used_item[p : p + low] = True
                used_text[q : q + low] = True
                tiles.append((p, q, low))
        most = low


def _tiled(batches):
    for batch in batches:
        marked, n_tiles, longest = [], [], []
        for item, codes, apart, size in zip(*(batch.column(k).to_pylist() for k in ("item", "codes", "apart", "size")), strict=True):
            text = np.frombuffer(codes, np.uint64)
            gaps = np.unpackbits(np.frombuffer(apart, np.uint8), count=len(text)).astype(bool)
            tiles = tiles_of(np.frombuffer(item, np.uint64), text, gaps, size)
            marked.append(sum(n for _, _, n in tiles))
            n_tiles.append(len(tiles))
            longest.append(max([n for _, _, n in tiles], default=0))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in ("doc_id", "item_id", "n_tokens")), pa.array(n_tiles, pa.int32()), pa.array(longest, pa.int32()), pa.array(marked, pa.int32())],
            names=["doc_id", "item_id", "n_tokens", "n_tiles", "longest", "marked"],
        )


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents holding a benchmark item: ``doc_id, item_id, n_tokens, n_tiles, longest, marked, coverage``.

    One row for each pair whose tiles cover at least ``coverage`` of the item's tokens (``n_tokens``).
    An item shorter than ``SEED`` tokens must occur whole. Texts that are null or without tokens match
    nothing; rows without an id are left out. Each row is a text of its own; of the rows of one id, and of the items of one
    id, the pair with the greatest coverage is given. Other columns are ignored. Empty tables give no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null").distinct()
    items = saved(
        items.mapInArrow(_item_rows, "item_id long, item binary, n_tokens int, size int, prints array<long>, times array<long>").withColumn("entry", F.monotonically_increasing_id()),
        "items",
    )
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # SEED of them at most
    known = documents.sparkSession.sparkContext.broadcast(_bitmap(items))
    hits = docs.mapInArrow(_hit_rows(known, sizes), "doc_id long, prints array<long>, codes binary, apart binary") if sizes else docs.select(
        F.col("id").alias("doc_id"), F.array().cast("array<long>").alias("prints"), F.lit(b"").alias("codes"), F.lit(b"").alias("apart")
    ).where("false")
    hits = saved(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    seeds = items.select("entry", "n_tokens", "size", F.explode(F.arrays_zip("prints", "times")).alias("x")).select("entry", "n_tokens", "size", "x.prints", "x.times")
    shared = hits.select("row", F.explode("prints").alias("prints")).join(seeds, "prints").groupBy("row", "entry").agg(
        F.sum("times").alias("windows"), F.first("n_tokens").alias("n"), F.first("size").alias("seed")
    )
    # as many windows cover at most SEED times as many tokens
    pairs = shared.where(F.col("windows") * F.col("seed") >= coverage * F.col("n")).select("row", "entry")
    both = pairs.join(items.drop("prints", "times"), "entry").join(hits.drop("prints"), "row")
    tiled = both.select("doc_id", "item_id", "item", "n_tokens", "size", "codes", "apart").mapInArrow(
        _tiled, "doc_id long, item_id long, n_tokens int, n_tiles int, longest int, marked int"
    )
    enough = tiled.withColumn("coverage", F.col("marked") / F.col("n_tokens")).where((F.col("coverage") >= coverage) & (F.col("marked") >= F.least("n_tokens", F.lit(SEED))))
    rest = ["n_tokens", "n_tiles", "longest", "marked"]
    best = enough.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", *rest)).alias("x"))
    return best.select("doc_id", "item_id", *(f"x.{c}" for c in rest), "x.coverage")
