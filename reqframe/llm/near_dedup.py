"""Near-duplicate documents: HyperMinHash registers, banding, estimate, exact confirmation.

A text is lower-cased (A-Z) and split at ASCII white space; its set is that of its distinct
five-word shingles (a shorter text is one shingle, an empty one has none). Shingles are 64-bit
hashes, so a confirmed link is exact up to hash collisions.

* Sketch: the hash range is cut into ``BINS`` buckets. A register keeps the bucket's smallest hash
  as a count of leading zeros (6 bits) and the ``MANTISSA`` bits behind them: 2 bytes a bucket.
* Equal sets are one node, named by a hash of the set, before anything is compared. A group is named
  by its smallest doc_id.
* Sets under ``SMALL`` shingles lose no link. Sets up to ``SMALL / similarity`` (the largest that can link
  with one of them) share a bucket for each of their n - ceil(similarity * n) + 1 rarest shingles: two
  sets that are similar enough have one of these in common. Rarity is the count of the at most ``HOT``
  commonest shingles, then the hash; any one order will do. Such pairs skip the estimate: registers
  differ in at most as many buckets as the sets differ in shingles.
* Banding of the others: ``BANDS`` bands of ``ROWS`` registers; empty buckets borrow the register of a
  hashed non-empty bucket. With independent bands a link at 0.75 is missed with probability
  (1 - 0.75**6)**42 = 2.6e-4, at 0.8 with 3e-6; borrowed registers make it more (see the README).
* Estimate: equal registers less the expected accidental collisions, over the buckets in use. A pair
  is let through if a similarity of 0.75 lies within four standard errors.
* Confirmation on full sets of the two texts.

Buckets are never expanded into pairs; links are found by contraction. In each round every node of a bucket
that holds several components is held against one node of another of them; confirmed links contract
components at once, refused pairs are remembered, and rounds go on while they close buckets. That joins large
groups of copies by linear work. What is left are buckets whose components are not linked through such nodes:
their registers meet in blocks of about ``BLOCK`` nodes a side, across components only, pairs that pass the estimate by half
the bits of their shingles if both sets are small enough to carry, and each node hands on its best few pairs. If it had more, a further round takes several times as many, of buckets still open. So no
pair of a bucket stays untested unless its nodes are linked already, and pairs between linked nodes are not listed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import components, forget, saved

WORDS = 5
BINS = 256
MANTISSA = 10
ROWS = 6
BANDS = 42
EMPTY = 0xFFFF
#: Nodes of a bucket that are compared in one task, nodes compared at a time, pairs of a node in the first round, and how many times more in the next.
BLOCK = 4096
SIDE = 512
MOST = 16
MORE = 16
#: Sets up to this size are held against one another by 32 bits of each shingle before a pair is handed on.
HALVES = 1024
#: A round of contraction is followed by another if it leaves at most this share of the rows of open buckets.
GAIN = 0.9
SMALL = 64
HOT = 65_536

_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash; emptied when full, so that a worker's memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words_to_hash: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(words_to_hash.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total += mix(codes[k : k + count] + _STEP[k])  * _STEP[k]
    return np.unique(mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted hash set (uint16; ``EMPTY`` where a bucket has none)."""
    out = np.full(BINS, EMPTY, np.uint16)
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = hashes[first] & np.uint64((1 << 56) - 1)
    _, bits = np.frexp(low.astype(np.float64))  # rounding up at 53 bits moves the code by one step at most
    zeros = np.clip(56 - bits, 0, 56).astype(np.uint64)
    tail = (low << (zeros + np.uint64(9))) >> np.uint64(64 - MANTISSA)
    out[bucket[first]] = ((zeros << np.uint64(MANTISSA)) | tail).astype(np.uint16)
    return out


_TRIES = mix(np.arange(BINS * 64, dtype=np.uint64) + np.uint64(77)).reshape(64, BINS) % np.uint64(BINS)
_ROW_SALT = mix(np.arange(BINS, dtype=np.uint64) + np.uint64(1 << 40))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """``BANDS`` 64-bit keys for each row of registers; empty buckets borrow from hashed others first."""
    full = regs.astype(np.uint64)
    row, col = np.nonzero(regs == EMPTY)
    for tries in _TRIES:
        if not len(row):
            break
        source = tries[col].astype(np.int64)
        lent = regs[row, source]
        ok = lent != EMPTY
        full[row[ok], col[ok]] = lent[ok].astype(np.uint64) + (source[ok].astype(np.uint64) << np.uint64(16))
        row, col = row[~ok], col[~ok]
    for step in range(1, BINS):  # what is left looks at every bucket in turn
        if not len(row):
            break
        source = (col + step) % BINS
        lent = regs[row, source]
        ok = lent != EMPTY
        full[row[ok], col[ok]] = lent[ok].astype(np.uint64) + (source[ok].astype(np.uint64) << np.uint64(16))
        row, col = row[~ok], col[~ok]
    cells = mix(full[:, : ROWS * BANDS] + _ROW_SALT[: ROWS * BANDS]).reshape(-1, BANDS, ROWS)
    return mix(cells.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def most_small(percent: int) -> int:
    """The largest set that can link with one under ``SMALL`` shingles."""
    return (SMALL - 1) * 100 // percent


def prefix(hashes: np.ndarray, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest shingles of a sorted set, one of which every similar enough set has among its own.

    ``hot``: sorted hashes of the commonest shingles and their counts.
    """
    known, counts = hot
    rank = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[at] == hashes, counts[at], 0)
    n = len(hashes)
    return hashes[np.argsort(rank, kind="stable")[: n - -(-percent * n // 100) + 1]]


_LEVELS = 2.0 ** -np.arange(56)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of register rows, and the buckets they rest on."""
    used = (a != EMPTY) | (b != EMPTY)
    count = used.sum(axis=1).astype(float)
    equal = ((a == b) & used).sum(axis=1).astype(float)
    x, y = n_a[:, None] / BINS, n_b[:, None] / BINS
    rate = x + y
    mass = np.exp(-rate * _LEVELS / 2) - np.exp(-rate * _LEVELS)
    chance = (x * y / np.maximum(rate, 1e-12) * mass * (_LEVELS / 2 / 2**MANTISSA)).sum(axis=1)
    return np.clip((equal - chance * count) / np.maximum(count, 1), 0, 1), count


def _sketch(most: int):
    """Registers of every text; sets of at most ``most`` shingles also whole."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [shingles(x, hashes) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in rows], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in rows], pa.binary()),
                        pa.array([registers(x).tobytes() if len(x) else None for x in rows], pa.binary()),
                        pa.array([x.tobytes() if 0 < len(x) <= most else None for x in rows], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "regs", "small"],
                )

    return run


def _set_of(small: bytes) -> np.ndarray:
    return np.frombuffer(small, np.uint64)


def _all_shingles(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(_set_of(b"".join(batch.column("small").to_pylist())).view(np.int64))], names=["shingle"])


def _commonest(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``HOT`` shingles of small sets and their counts, as many powers of two down as there is room for."""
    shingle = nodes.where("small is not null").select("small").mapInArrow(_all_shingles, "shingle long")
    counts = saved(shingle.groupBy("shingle").count().where("count > 4"), "shingles")
    # one row for each power of two
    levels = dict(counts.groupBy(F.length(F.bin("count")).alias("level")).count().collect())
    least, total = 64, 0
    for level in sorted(levels, reverse=True):
        if (total := total + levels[level]) > HOT:
            break
        least = level
    got = counts.where(F.length(F.bin("count")) >= least).toArrow()
    known, count = got.column("shingle").to_numpy().view(np.uint64), got.column("count").to_numpy()
    order = np.argsort(known)
    return known[order], count[order]


def _bands(percent: int, hot):
    """Buckets of each node: its rarest shingles if its set is small, bands if it is not."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                node, n = (part.column(k).to_numpy(zero_copy_only=False) for k in ("node", "n"))
                rare = [prefix(_set_of(x), percent, hot.value).view(np.int64) if x is not None else np.empty(0, np.int64) for x in part.column("small").to_pylist()]
                large = np.flatnonzero(n >= SMALL)
                keys = band_keys(_registers_of(part, "regs")[large]).reshape(-1)
                keys = np.concatenate([keys, *rare])
                owner = np.concatenate([np.repeat(node[large], BANDS), np.repeat(node, [len(x) for x in rare])])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owner)], names=["band", "node"])

    return run


def _compared(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether ``similarity`` lies within four standard errors of the estimate, and sizes allow it; and equal registers.

    Buckets in use draw one shingle each from the union without replacement, so the error shrinks as
    the number of buckets in use comes near the size of the union. Small sets are not estimated but
    bounded, so that no similar pair fails.
    """
    value, count = estimate(a, b, n_a, n_b)
    count = np.maximum(count, 1)
    union = np.maximum((n_a + n_b) / (1 + similarity), 2)
    left = np.clip((union - count) / (union - 1), 0.05, 1)
    slack = 4 * np.sqrt(similarity * (1 - similarity) / count * left) + 2 / count
    small = np.maximum(n_a, n_b) <= most_small(round(similarity * 100))
    # a bucket that differs holds a shingle of one set alone
    apart = (a != b).sum(axis=1)
    close = np.where(small, apart * (1 + similarity) <= (n_a + n_b) * (1 - similarity) + 1e-9, value >= similarity - slack)
    return close & (np.minimum(n_a, n_b) >= similarity * np.maximum(n_a, n_b) - 1e-9), BINS - apart


def _registers_of(batch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(-1, BINS)


def _estimated(similarity: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in ("n_a", "n_b")]
            keep, _ = _compared(_registers_of(batch, "regs_a"), _registers_of(batch, "regs_b"), *sizes, similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _across(similarity: float, hot, most: int):
    """Pairs of different components in one group ``(band, low, high)``; rows come group by group.

    Each node gives the ``most`` best of its pairs with later ones, ``more`` says that it had others.
    """
    percent = round(similarity * 100)

    def pairs(group: pa.Table):
        side = group.column("side").to_numpy()
        node, part, n = (group.column(k).to_numpy() for k in ("node", "part", "n"))
        regs = _registers_of(group, "regs")
        halves = [None if x is None else np.frombuffer(x, np.uint32) for x in group.column("halves").to_pylist()]
        same = group.column("low")[0].as_py() == group.column("high")[0].as_py()
        left = np.arange(len(node)) if same else np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        found = []
        here = group.column("band")[0].as_py()
        bands = band_keys(regs)
        if rare := not (bands[0] == here).any():  # a shingle of small sets
            sets = group.column("small").to_pylist()
            below = [set() if x is None else {y for y in prefix(_set_of(x), percent, hot.value).view(np.int64).tolist() if y < here} for x in sets]
        order = (bands == here).argmax(axis=1)  # which of its bands this is
        for i in left.tolist():
            j = right[(part[right] != part[i]) & ((right > i) | (not same))]
            mine, equal = [], []
            for at in range(0, len(j), SIDE):
                k = j[at : at + SIDE]
                # a pair that shares several bands is left to the first of them
                if not rare:
                    k = k[(bands[k] == bands[i]).argmax(axis=1) == order[i]]
                if len(k):
                    one = np.broadcast_to(regs[i], (len(k), BINS))
                    ok, score = _compared(one, regs[k], np.full(len(k), n[i], float), n[k].astype(float), similarity)
                    if rare:
                        ok &= np.array([below[i].isdisjoint(below[x]) for x in k.tolist()], bool)
                    if halves[i] is not None:
                        for x in np.flatnonzero(ok).tolist():
                            ok[x] = halves[k[x]] is None or _may_share(halves[i], halves[k[x]], percent)
                    mine.append(k[ok])
                    equal.append(score[ok])
            if mine and len(j := np.concatenate(mine)):
                best = np.argsort(-np.concatenate(equal), kind="stable")[:most]
                found += [(int(node[i]), int(node[x]), len(j) > most) for x in j[best].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([min(a, b) for a, b, _ in found], pa.int64()), pa.array([max(a, b) for a, b, _ in found], pa.int64()), pa.array([m for *_, m in found], pa.bool_())],
            names=["a", "b", "more"],
        )

    def run(batches):
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("band", "low", "high")])
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                now = tuple(keys[lo].tolist())
                if held and now != at:
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                at = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def _upper_halves(batches):
    """The upper 32 bits of the shingles of each set with at most ``HALVES`` of them."""
    for batch in batches:
        out = []
        for x in batch.column("shingles").to_pylist():
            out.append((_set_of(x) >> np.uint64(32)).astype(np.uint32).tobytes() if len(x) <= 8 * HALVES else None)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "halves"])


def _may_share(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of upper halves leave room for the similarity: no common shingle is missed, few are taken for common."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _whole_sets(batches):
    """The shingles of each text, with the key of their set."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows = [shingles(x, hashes).tobytes() for x in part.column("text").to_pylist()]
            keys = [xxhash.xxh3_128_digest(x) for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(rows, pa.binary())], names=["set_key", "shingles"])


def _confirmed(similarity: float):
    percent = round(similarity * 100)

    def run(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                one, two = _set_of(one), _set_of(two)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Links:
    """Confirmed links as components of nodes, contracted batch by batch; pairs once tested are not tested again."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, members: DataFrame, similarity: float):
        self.sides = {
            k: nodes.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("regs").alias(f"regs_{k}")) for k in "ab"
        }
        self.sets, self.similarity = sets, similarity
        self.members = members
        self.label = saved(members.select("node").distinct().withColumn("part", F.col("node")), "parts")
        self.tested: DataFrame | None = None
        self.opened: DataFrame | None = None

    def open(self) -> DataFrame:
        """``band, node, part, p1, m1, p2, m2`` of buckets with several components, and two nodes of theirs."""
        labelled = self.members.select("band", "node").join(self.label, "node")
        firsts = labelled.groupBy("band", "part").agg(F.min("node").alias("m"))
        ends = firsts.groupBy("band").agg(
            F.min("part").alias("p1"), F.min_by("m", "part").alias("m1"), F.max("part").alias("p2"), F.max_by("m", "part").alias("m2")
        )
        if self.opened is not None:
            forget(self.opened)
        self.opened = saved(labelled.join(ends.where("p1 < p2"), "band"), "open")
        return self.opened

    def untested(self, pairs: DataFrame) -> DataFrame:
        return pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti")

    def test(self, pairs: DataFrame, estimated: bool) -> bool:
        """Test saved pairs ``a < b`` that were not tested before; whether any is a link. Links contract components."""
        tried = pairs.select("a", "b")
        tested = saved(tried if self.tested is None else self.tested.unionByName(tried), "tested")
        if self.tested is not None:
            forget(self.tested)
        self.tested = tested
        if not estimated:
            sided = tried.join(self.sides["b"], "b").join(self.sides["a"], "a")
            tried = saved(sided.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(_estimated(self.similarity), "a long, b long"), "close")
        full = {k: self.sets.select(F.col("node").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "ab"}
        links = tried.join(full["b"], "b").join(full["a"], "a").select("a", "b", "set_a", "set_b")
        links = saved(links.mapInArrow(_confirmed(self.similarity), "a long, b long"), "confirmed")
        if links.isEmpty():
            return False
        parts = {k: self.label.select(F.col("node").alias(k), F.col("part").alias(f"part_{k}")) for k in "ab"}
        met = components(links.join(parts["a"], "a").join(parts["b"], "b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
        new = self.label.join(met.select(F.col("node").alias("part"), "component"), "part", "left")
        new = saved(new.select("node", F.coalesce("component", "part").alias("part")), "parts")
        forget(self.label)
        self.label = new
        return True


def near_groups(documents: DataFrame, similarity: float = 0.75) -> DataFrame:
    """Groups of near-duplicate documents: ``doc_id, n_shingles, component_id, kept``.

    One row for each row of ``documents`` (``doc_id``, ``text``; other columns are ignored). Null
    and empty texts have no shingles and form groups of their own. Rows without a doc_id link with
    nothing, have a null component and are kept. Repeated rows are copies of one another; rows of
    one id with different texts are grouped each by its own text. An empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    percent = round(similarity * 100)
    sketch = saved(
        docs.mapInArrow(_sketch(most_small(percent)), "doc_id long, n_shingles long, set_key binary, regs binary, small binary"), "sketch"
    )
    ids = sketch.where("doc_id is not null and n_shingles > 0")
    sets = ids.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    sets = saved(sets.withColumn("node", F.xxhash64("set_key")), "sets")
    nodes = saved(
        sets.alias("s")
        .join(
            ids.select("doc_id", F.col("set_key").alias("own_key"), "regs", "small"),
            (F.col("first_id") == F.col("doc_id")) & (F.col("set_key") == F.col("own_key")),
        )
        .dropDuplicates(["node", "set_key"])
        .select("node", "doc_id", "set_key", "n", "regs", "small"),
        "nodes",
    )
    hot = documents.sparkSession.sparkContext.broadcast(_commonest(nodes))
    bands = nodes.select("node", "n", "regs", "small").mapInArrow(_bands(percent, hot), "band long, node long")
    heads = bands.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
    members = saved(
        bands.join(heads.select(F.col("band").alias("key")), F.col("band") == F.col("key")).select("band", "node"),
        "members",
    )
    # the full sets of nodes that share a bucket, from one text of each
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "doc_id", "set_key")
    texts = docs.join(wanted.select("doc_id").distinct(), "doc_id").select("text")
    whole = texts.mapInArrow(_whole_sets, "set_key binary, shingles binary").join(wanted.select("node", "set_key"), "set_key")
    whole = saved(whole.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")
    links = _Links(nodes, whole, members, similarity)

    # contraction: each node is held against one node of another component, chosen from ids alone, while that closes buckets
    before, left = math.inf, links.open().count()
    while 0 < left <= GAIN * before:
        partner = F.when(F.col("part") == F.col("p1"), F.col("m2")).otherwise(F.col("m1"))
        offers = links.opened.select(F.least("node", partner).alias("a"), F.greatest("node", partner).alias("b"), "node")
        shared = offers.groupBy("a", "b", "node").count()
        best = shared.groupBy("node").agg(F.max(F.struct("count", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
        best = saved(links.untested(best), "stars")
        if not links.test(best, estimated=False):
            break
        before, left = left, links.open().count()

    halves = whole.mapInArrow(_upper_halves, "node long, halves binary")
    sketches = nodes.select("node", "n", "regs", "small").join(halves, "node")

    # what is left: all pairs across components, the best of each node first
    most = MOST
    while True:
        rest = links.opened.select("band", "node", "part")
        sizes = rest.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        rest = rest.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        dealt = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select(
            "band",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "node",
            "part",
        ).join(sketches, "node")
        dealt = dealt.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
        found = dealt.mapInArrow(_across(similarity, hot, most), "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))
        found = saved(found, "across")
        contracted = links.test(saved(links.untested(found.select("a", "b")), "pairs"), estimated=True)
        if found.where("more").isEmpty():
            break
        most *= MORE
        if contracted:
            links.open()
    label = links.label.withColumnRenamed("part", "component")

    group = sets.join(label, "node", "left").select(F.col("set_key").alias("key"), "first_id", F.coalesce("component", "node").alias("part"))
    named = group.groupBy(F.col("part").alias("of")).agg(F.min("first_id").alias("component_id"))
    group = group.join(named, F.col("part") == F.col("of")).select("key", "component_id")
    linked = ids.join(group, F.col("set_key") == F.col("key"), "left").select("doc_id", "n_shingles", "component_id")
    alone = sketch.where("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
