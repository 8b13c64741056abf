"""Repeated passages by suffix order: longest-previous-factor arrays over content-defined buckets.

A passage is a string of ``LENGTH`` bytes that starts in more than one place. The longest previous factor
(LPF) of a place is the longest string that starts there and also at an earlier place; it comes from the
previous and the next smaller place in suffix order. A place's string is repeated if its LPF reaches
``LENGTH``, or the LPF of the reversed order does (a later copy). Operators may remove later copies and
keep the first, or remove every copy.

No suffix array holds the whole corpus. Equal strings are brought together first:

* Equal texts are one text with several documents (``texts_of``, written in buckets by the text's key, so that
  later joins by key don't move texts again).
* Every string of ``LENGTH`` bytes has an *anchor*, the least of its hashed grams of ``GRAM`` bytes, the
  leftmost of equal ones. Equal strings have equal grams there, so places whose gram occurs once are done.
* The strings of one anchor start one after the other. Together they are a *context* of at most
  ``LENGTH + SPREAD - 1`` bytes. Contexts of a gram that are all equal need no order: all their strings repeat.
* Other grams' distinct contexts are a bucket. A bucket of over ``MOST`` contexts is cut into the halves of the
  distances between string and anchor, and within them by the bytes that all strings of a half have; at
  distances of one the bucket is one string. No context is dropped, and copies are counted, not compared.
* In each bucket the suffixes of its contexts are sorted by prefix doubling, and LPF arrays are taken.

Texts are UTF-8 bytes, null is empty. Texts under ``LENGTH`` bytes have nothing to remove. Repeated rows are
copies; places are ordered by the smallest doc_id of their text (null last), the text's key, and the offset. Long
texts are cut into overlapping stretches for hashing only. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import saved
from reqframe.session import shared_dir

LENGTH = 400
GRAM = 128
#: Places at which the anchor of a string can lie.
SPREAD = LENGTH - GRAM + 1
#: Contexts of a bucket that are sorted together; larger buckets are cut.
MOST = 1024
#: Bytes hashed at a time; offsets within them fit in the low bits of a hash.
STRETCH = 1 << 20
#: Bytes whose suffixes are sorted at a time, whole buckets.
SORTED = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Anchors of a stretch of bytes."""

    def __init__(self):
        self.of_byte = _mix(np.arange(1, 257, dtype=np.uint64))
        ones = np.full(STRETCH + 1, _BASE, np.uint64)
        ones[0] = 1
        self.up = np.cumprod(ones)
        ones[1:] = np.uint64(pow(_BASE, -1, 2**64))
        self.down = np.cumprod(ones)

    def grams(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the gram at each place."""
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.up[: len(data)], out=total[1:])
        return _mix((total[GRAM:] - total[:-GRAM]) * self.down[: len(data) - GRAM + 1])

    def anchors(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place that a string of ``LENGTH`` bytes starts at, its anchor's place; and all hashes."""
        hashes = self.grams(data)
        low = np.uint64(STRETCH - 1)
        marked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        n = len(marked)
        padded = np.full(-(-n // SPREAD) * SPREAD, np.uint64(2**64 - 1))
        padded[:n] = marked
        blocks = padded.reshape(-1, SPREAD)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - SPREAD + 1], ahead[SPREAD - 1 : n])
        return (least & low).astype(np.int64), hashes


def _stretches(texts: list[bytes]):
    """Texts put together, or long ones cut, to stretches: data, and per piece (text, offset, start, end).

    Pieces of one text overlap by ``LENGTH - 1`` bytes, so that every string lies in one of them and starts in one.
    """
    held, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, STRETCH - LENGTH):
            part = text[at : at + STRETCH - 1]
            if size + len(part) >= STRETCH:
                yield np.frombuffer(b"".join(held), np.uint8), pieces
                held, pieces, size = [], [], 0
            pieces.append((i, at, size, size + len(part)))
            held.append(part)
            size += len(part)
    if pieces:
        yield np.frombuffer(b"".join(held), np.uint8), pieces


def anchors_of(texts: list[bytes], hasher: Hasher):
    """``(text, anchor, first start, last start, gram hash)`` for each run of strings with one anchor."""
    for data, pieces in _stretches(texts):
        anchor, hashes = hasher.anchors(data)
        for i, at, start, end in pieces:
            mine = anchor[start : min(end - LENGTH + 1, start + STRETCH - LENGTH)]
            first = np.flatnonzero(np.diff(mine, prepend=-1))
            last = np.append(first[1:], len(mine)) - 1
            spot = mine[first]
            yield i, spot - start + at, first + at, last + at, hashes[spot].view(np.int64)


def _text_key():
    return F.unhex(F.md5(F.col("text")))


def texts_of(documents: DataFrame) -> DataFrame:
    """Distinct texts: ``tk`` (128-bit key), ``first_id``, ``n_docs``, ``text`` as bytes; a table in buckets by ``tk``."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    # rows without an id come last
    texts = docs.withColumn("tk", _text_key()).groupBy("tk").agg(
        F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("first_id"), F.count("*").alias("n_docs"), F.first("text").alias("text")
    )
    name = f"reqframe_texts_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/reqframe-llm/{spark.sparkContext.applicationId}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.format("parquet").bucketBy(buckets, "tk").option("path", path).saveAsTable(name)
    return spark.table(name)


def _scanned(with_spots: bool):
    """Anchors of texts: ``gram, place`` (a hash of text and anchor), or ``gram, tk, spot``."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts, keys = part.column("text").to_pylist(), part.column("tk").to_pylist()
                grams, owners, spots = [], [], []
                for i, anchor, first, last, gram in anchors_of(texts, hasher):
                    grams.append(gram)
                    owners.append(np.full(len(gram), i))
                    spots.append(_spot(anchor, first, last) if with_spots else anchor)
                if not grams:
                    continue
                gram, owner, spot = np.concatenate(grams), np.concatenate(owners), np.concatenate(spots)
                if with_spots:
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(keys, pa.binary()).take(pa.array(owner)), pa.array(spot)], names=["gram", "tk", "spot"])
                else:
                    salt = np.array([int.from_bytes(k[:8], "little") for k in keys], np.uint64)[owner]
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(_mix(salt ^ _mix(spot.astype(np.uint64))).view(np.int64))], names=["gram", "place"])

    return run


def _spot(anchor, first, last):
    """Anchor and the distances to the first and last start, in one number."""
    return (anchor << 20) | ((anchor - first) << 10) | (anchor - last)


def _unspot(spot):
    return spot >> 20, (spot >> 10) & 1023, spot & 1023


ROW = "gram long, context binary, bucket long, part binary, first struct<first_id:long,tk:binary,spot:long>, many boolean, far int, near int, bytes binary"


def _strings_of(text: bytes, spot: int) -> tuple[bytes, int, int]:
    """The bytes of all strings of a spot, and their farthest and nearest distances to the anchor."""
    anchor, far, near = _unspot(spot)
    return text[anchor - far : anchor - near + LENGTH], far, near


def _contexts(batches):
    """A key for the strings of each spot and their distances to the anchor."""
    for batch in batches:
        out = []
        for tk, first_id, text, spots in zip(*(batch.column(k).to_pylist() for k in ("tk", "first_id", "text", "spots")), strict=True):
            for x in spots:
                data, far, _ = _strings_of(text, x["spot"])
                out.append((x["gram"], xxhash.xxh3_128_digest(data, seed=far), first_id, tk, x["spot"]))
        if out:
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "context", "first_id", "tk", "spot"])


def _with_bytes(schema):
    def run(batches):
        for batch in batches:
            out = []
            for tk, first_id, text, wanted in zip(*(batch.column(k).to_pylist() for k in ("tk", "first_id", "text", "wanted")), strict=True):
                for x in wanted:
                    data, far, near = _strings_of(text, x["spot"])
                    first = {"first_id": first_id, "tk": tk, "spot": x["spot"]}
                    out.append({"gram": x["gram"], "context": x["context"], "bucket": x["gram"], "part": x["context"], "first": first, "many": x["many"], "far": far, "near": near, "bytes": data})
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _halves(size: int):
    """Rows of a bucket dealt to halves of the distances, by the bytes that all strings of a half have."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for q in range(r["near"] // size, r["far"] // size + 1):
                    near, far = max(r["near"], q * size), min(r["far"], (q + 1) * size - 1)
                    data = r["bytes"][r["far"] - far : len(r["bytes"]) - (near - r["near"])]
                    core = data[far - q * size : far - (q + 1) * size + 1 + LENGTH]
                    bucket = xxhash.xxh3_64_intdigest(core, seed=(r["bucket"] ^ (q + 1) * _BASE) % 2**64)
                    out.append(r | {"bucket": bucket - (bucket >> 63 << 64), "part": xxhash.xxh3_128_digest(data, seed=far), "near": near, "far": far, "bytes": data})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return run


# ---------------------------------------------------------------- suffix order


def suffix_order(data: np.ndarray, length: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``length`` bytes, by prefix doubling.

    Returns the ranks for each length on the way (8, 16, …), the order, and the rank by ``length`` bytes.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    value = np.zeros(n, np.uint64)
    for k in range(8):
        value = (value << np.uint64(8)) | padded[k : k + n]
    # a rank is the place of its group's first suffix, so that groups are refined each for itself
    first = np.argsort(value)
    new_group = np.concatenate([[True], np.diff(value[first]) != 0])
    rank = np.empty(n, np.int64)
    rank[first] = np.maximum.accumulate(np.where(new_group, np.arange(n), 0))
    levels, size = [(8, rank)], 8
    alone = np.empty(n, bool)
    alone[first] = new_group & np.append(new_group[1:], True)
    going = np.flatnonzero(~alone)
    while size < length:
        by = min(size, length - size)
        rank = rank.copy()
        if len(going):
            after = np.zeros(len(going), np.int64)
            inside = going + by < n
            after[inside] = levels[-1][1][going[inside] + by] + 1
            key = rank[going] * (n + 2) + after
            sort = np.argsort(key)
            going, key = going[sort], key[sort]
            old = rank[going]
            place = np.arange(len(going))
            start = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(old) != 0]), place, 0))
            new_group = np.concatenate([[True], np.diff(key) != 0])
            rank[going] = old + np.maximum.accumulate(np.where(new_group, place, 0)) - start
            going = going[~(new_group & np.append(new_group[1:], True))]
        size += by
        levels.append((size, rank))
    return levels, np.argsort(rank), rank


def common_prefix(levels, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes suffixes a and b share, up to the length that ``levels`` end with."""
    n, length = len(data), levels[-1][0]
    same = levels[-1][1][a] == levels[-1][1][b]
    shared = np.zeros(len(a), np.int64)
    for size, rank in reversed(levels[:-1]):
        x, y = a + shared, b + shared
        inside = (np.maximum(x, y) < n) & (shared + size <= length)
        equal = np.zeros(len(a), bool)
        equal[inside] = rank[x[inside]] == rank[y[inside]]
        shared += size * equal
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    going = np.ones(len(a), bool)
    for _ in range(7):
        x, y = np.minimum(a + shared, n), np.minimum(b + shared, n)
        going &= padded[x] == padded[y]
        shared += going
    return np.where(same, length, np.minimum(shared, length - 1))


def longest_previous_factors(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """LPF of suffixes in suffix order; ``lcp[i]`` is what suffix i shares with the one before it.

    The previous and the next smaller place of each suffix are found by jumping along earlier finds, all
    suffixes at once; what it shares with them is the least LCP on the way.
    """

    def smaller_before(place, lcp):
        to, least = np.arange(len(place)) - 1, lcp.copy()
        going = np.arange(1, len(place))
        while len(going):
            # what lies between a place and its stop is larger, so the stop's own stop may be taken, final or not
            going = going[place[to[going]] > place[going]]
            stop = to[going]
            least[going] = np.minimum(least[going], least[stop])
            to[going] = to[stop]
            going = going[to[going] >= 0]
        return np.where(to >= 0, least, 0)

    if not len(place):
        return np.zeros(0, np.int64)
    behind = np.append(lcp[1:], 0)
    return np.maximum(smaller_before(place, np.concatenate([[0], lcp[1:]])), smaller_before(place[::-1], behind[::-1])[::-1])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def repeated_starts(buckets: list[int], contexts: list[bytes], many: list[bool]) -> list[tuple[list, list]]:
    """For each context, runs of starts whose string is anywhere else, and of those that are found earlier.

    Contexts come bucket by bucket, in order of their first places; only strings of one bucket are compared.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(x) for x in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    levels, order, rank = suffix_order(data, LENGTH)
    # suffixes at which a string starts, within one bucket
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(data)) - starts[owner]
    wanted = offset + LENGTH <= sizes[owner]
    order = order[wanted[order]]
    by = np.unique(np.array(buckets, np.int64), return_inverse=True)[1]
    group = by[owner]
    order = order[np.argsort(group[order], kind="stable")]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = common_prefix(levels, data, order[1:], order[:-1])
    lcp[1:][group[order[1:]] != group[order[:-1]]] = 0
    earlier, anywhere = np.zeros(len(data), bool), np.zeros(len(data), bool)
    previous = longest_previous_factors(order, lcp) >= LENGTH
    earlier[order] = previous
    anywhere[order] = previous | (longest_previous_factors(-order, lcp) >= LENGTH)
    out = []
    for at, size, more in zip(starts, sizes, many, strict=True):
        end = at + size - LENGTH + 1
        out.append(([(0, int(size) - LENGTH)] if more else _runs(anywhere[at:end]), _runs(earlier[at:end])))
    return out


PART = "bucket long, part binary, first struct<first_id:long,tk:binary,spot:long>, anywhere binary, earlier binary"


def _packed(runs, far: int) -> bytes:
    """Runs of starts as distances from the anchor: the farthest first."""
    return np.array([(far - a, far - b) for a, b in runs], "<i4").tobytes()


def _sorted_buckets(batches):
    held, size, kind = [], 0, []

    def close():
        rows = repeated_starts([r["bucket"] for r in held], [r["bytes"] for r in held], [r["many"] for r in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([r["bucket"] for r in held], pa.int64()), pa.array([r["part"] for r in held], pa.binary()), pa.array([r["first"] for r in held], kind[0]),
             pa.array([_packed(x, r["far"]) for r, (x, _) in zip(held, rows, strict=True)], pa.binary()),
             pa.array([_packed(x, r["far"]) for r, (_, x) in zip(held, rows, strict=True)], pa.binary())],
            names=["bucket", "part", "first", "anywhere", "earlier"],
        )

    for batch in batches:
        kind = [batch.schema.field("first").type]
        for r in batch.to_pylist():
            if size >= SORTED and r["bucket"] != held[-1]["bucket"]:
                yield close()
                held, size = [], 0
            held.append(r)
            size += len(r["bytes"])
    if held:
        yield close()


def _united(runs: np.ndarray) -> np.ndarray:
    """Half-open spans united where they overlap or touch, in order."""
    if not len(runs):
        return runs
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    first = np.concatenate([[True], runs[1:, 0] > reach[:-1]])
    return np.column_stack([runs[first, 0], reach[np.append(np.flatnonzero(first)[1:] - 1, len(runs) - 1)]])


def _spans_of(keep_first: bool):
    """Spans ``tk, begin, end`` of the text that a spot's repeated strings cover."""

    def run(batches):
        for batch in batches:
            number = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("spot", "is_first", "whole")}
            anchor, *own = _unspot(number["spot"])
            given = [pc.is_valid(batch.column(k)).to_numpy(zero_copy_only=False) for k in ("far", "near")]
            ends = [pc.fill_null(batch.column(k), 0).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("far", "near")]
            far, near = (np.where(g, x, o) for g, x, o in zip(given, ends, own, strict=True))
            runs = batch.column("earlier" if keep_first else "anywhere")
            # all of a row's strings, or runs of them
            every = ~(number["is_first"] & ~number["whole"]) if keep_first else ~pc.is_valid(runs).to_numpy(zero_copy_only=False)
            some = np.flatnonzero(~every)
            packed = runs.take(pa.array(some)).to_pylist()
            pairs = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2).astype(np.int64)
            row = np.concatenate([np.flatnonzero(every), np.repeat(some, np.fromiter(map(len, packed), np.int64, len(packed)) // 8)])
            far, near = np.concatenate([far[every], pairs[:, 0]]), np.concatenate([near[every], pairs[:, 1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tk").take(pa.array(row)), pa.array(anchor[row] - far), pa.array(anchor[row] - near + LENGTH)], names=["tk", "begin", "end"]
            )

    return run


def repeated_spans(texts: DataFrame, keep_first: bool) -> DataFrame:
    """``tk, begins, ends``: byte spans of each distinct text to remove, which may overlap; texts without any are left out.

    With ``keep_first`` only strings that also start at an earlier place count, otherwise those that start anywhere else.
    """
    long_texts = texts.where(F.octet_length("text") >= LENGTH)
    places = long_texts.select("tk", "text").mapInArrow(_scanned(False), "gram long, place long")
    # written, so that both sides of the joins below are shuffled for them and a hot gram can be split
    grams = saved(places.groupBy("gram").agg(F.min("place").alias("one"), F.max("place").alias("two")).where("one < two").select("gram"), "grams")
    spots = long_texts.select("tk", "text").mapInArrow(_scanned(True), "gram long, tk binary, spot long").join(grams, "gram")
    # a text's spots are fewer than its bytes
    listed = spots.groupBy("tk").agg(F.collect_list(F.struct("gram", "spot")).alias("spots"))
    strings = long_texts.join(listed, "tk").select("tk", "first_id", "text", "spots")
    contexts = saved(strings.mapInArrow(_contexts, "gram long, context binary, first_id long, tk binary, spot long"), "contexts")
    place = F.struct("first_id", "tk", "spot")
    distinct = contexts.groupBy("gram", "context").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    distinct = saved(distinct.select("gram", "context", "first", F.expr("first < last").alias("many")), "distinct")
    kinds = saved(distinct.groupBy("gram").agg(F.count("*").alias("kinds")), "kinds")

    # one context in several places: every string repeats
    alone = distinct.join(kinds.where("kinds = 1").select("gram"), "gram").where("many").select("gram", "context")
    parts = [alone.selectExpr("gram", "context", "cast(null as int) far", "cast(null as int) near", "cast(null as binary) anywhere", "X'' earlier", "false whole")]

    # several contexts: buckets of distinct ones, cut while they are too large
    mixed = distinct.join(kinds.where("kinds > 1").select("gram"), "gram")
    wanted = mixed.groupBy("first.tk").agg(F.collect_list(F.struct("gram", "context", "first.spot", "many")).alias("wanted"))
    rows = long_texts.join(wanted, "tk").select("tk", "first_id", "text", "wanted")
    rows = saved(rows.mapInArrow(_with_bytes(_arrow(rows.sparkSession, ROW)), ROW), "mixed")
    counted, size = rows.select("bucket", "part", "first", "many"), 1 << (SPREAD - 1).bit_length()
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        sizes = saved(counted.groupBy("bucket").agg(F.count("*").alias("kinds"), F.max("many").alias("any_many")), "sizes")
        large = sizes.where(F.col("kinds") > MOST).select("bucket")
        cut = not large.isEmpty()
        ready = rows.select("bucket", "part", "first", "many", "far", "bytes")
        if cut or counted is not None and size < SPREAD:
            small = sizes.where((F.col("kinds") <= MOST) & ((F.col("kinds") > 1) | F.col("any_many"))).select("bucket")
            one = counted.join(small, "bucket").select("bucket", "part", "first", F.col("many").alias("more"))
            ready = ready.join(one, ["bucket", "part", "first"]).select("bucket", "part", "first", F.col("more").alias("many"), "far", "bytes")
        dealt = ready.repartition(n, "bucket").sortWithinPartitions("bucket", "first")
        results = dealt.mapInArrow(_sorted_buckets, PART).withColumnRenamed("first", "f")
        mine = rows.select("gram", "context", "bucket", "part", "first", "far", "near").join(results, ["bucket", "part"])
        # of the contexts that share a part only that of the first place may keep strings
        mine = mine.select("gram", "context", "far", "near", "anywhere", "earlier", (F.col("first") != F.col("f")).alias("whole"))
        parts.append(saved(mine, "found"))
        if not cut:
            break
        size //= 2
        rows = saved(rows.join(large, "bucket").select(rows.columns).mapInArrow(_halves(size), ROW), "halves")
        counted = rows.groupBy("bucket", "part").agg(F.min("first").alias("first"), F.max("first").alias("last"), F.max("many").alias("many"))
        counted = saved(counted.select("bucket", "part", "first", (F.col("many") | F.expr("first < last")).alias("many")), "counted")

    # back to places
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    firsts = distinct.select("gram", "context", "first")
    every = saved(every.join(firsts, ["gram", "context"]), "every")
    covered = contexts.join(every, ["gram", "context"]).select(
        "tk", "spot", (place == F.col("first")).alias("is_first"), "whole", "far", "near", "anywhere", "earlier"
    )
    spans = covered.mapInArrow(_spans_of(keep_first), "tk binary, begin long, end long")
    # in one order, as both lists take the rows as they come
    return spans.groupBy("tk").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))


def _arrow(spark, schema: str) -> pa.Schema:
    return pa.schema(spark.createDataFrame([], schema).toArrow().schema)


def _cut(keep_first: bool):
    """What is left of each distinct text: ``tk, first_id, n_docs, n_bytes, spans, kept``."""

    def run(batches):
        for batch in batches:
            rows = []
            bounds = [[np.array(x or (), np.int64) for x in batch.column(k).to_pylist()] for k in ("begins", "ends")]
            for tk, first_id, text, n_docs, begins, ends in zip(*(batch.column(k).to_pylist() for k in ("tk", "first_id", "text", "n_docs")), *bounds, strict=True):
                runs = np.column_stack([begins, ends])
                if n_docs > 1 and not keep_first and len(text) >= LENGTH:
                    runs = np.array([[0, len(text)]])
                runs = _united(runs)
                edges = [0, *runs.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((tk, first_id, n_docs, len(text), runs.astype("<i8").ravel().tolist(), kept))
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["tk", "first_id", "n_docs", "n_bytes", "edges", "kept"])

    return run


def deduplicated(documents: DataFrame, keep_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Texts without repeated passages, and which document has which text.

    The first frame has a row for each distinct text: ``tk``, ``first_id``, ``n_docs``, ``n_bytes``, ``edges`` (begin and end
    of each removed span in turn) and ``kept``, the bytes that stay in its first document. With ``keep_first``, later
    documents of an equal text (of ``LENGTH`` bytes at least) keep nothing; else no copy keeps a repeated string.
    The second frame is ``doc_id, tk``.
    """
    texts = texts_of(documents)
    spans = repeated_spans(texts, keep_first)
    cut = texts.join(spans, "tk", "left").select("tk", "first_id", "text", "n_docs", "begins", "ends").mapInArrow(
        _cut(keep_first), "tk binary, first_id long, n_docs long, n_bytes long, edges array<long>, kept binary"
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return cut, docs.select("doc_id", _text_key().alias("tk"))


def removal_digests(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` where every copy of a repeated string is removed."""
    cut, docs = deduplicated(documents, keep_first=False)
    digests = cut.select(
        "tk", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), (F.size("edges") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return docs.join(saved(digests, "digests"), "tk").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
