"""A z-fast trie over conversations: which turn sequences share prefixes, and what sharing them saves.

Each conversation is rebuilt (see ``rebuilt``) and read as a sequence of turns (role, text). A prefix is
known by two 64-bit sums of its turns' hashes, so two prefixes are compared by two numbers. The trie is
compacted: nodes stand where sequences branch or end. An edge belongs to the sequence that brought it in
(its *path*), so a node is a place ``(path, depth)``, and its edge covers the depths above its parent's.

* Handles: a node is stored under its prefix of the 2-fattest depth on its edge, the depth divisible by
  the largest power of two, in a table joined by depth and prefix.
* Fat binary search: a sequence looks up the 2-fattest depth between its bounds; a hit raises the lower
  bound to that node's depth, a miss drops the upper one below the handle. Its exit node is found after as
  many steps as its length has bits; the place where it leaves that node's edge comes from the edge itself.
* Batches: all sequences of a batch are located at once. Of those that leave the trie at one place with the same
  next turn one, drawn by a hash, is inserted with all its turns; the others leave the trie next where they
  leave that one. A sequence meets about half as many rivals in each round, whatever the trie's shape.
* Edges are expanded at the end: the turns on an edge have all their node's members.

Copies of a sequence enter once. Prefixes are summed up over ranges of rows, edges are cut in blocks, and
no conversation, node or edge has to fit in one task.

Null roles and texts are empty; rows without a conv_id are left out; rows of one turn, repeated ones
included, are ordered by a hash of role and text. Other columns are ignored. Conversations that are
rebuilt without turns are members of the root alone. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqframe.llm.common import saved
from reqframe.llm.ordered import running

#: Original turns that a conversation may take from the first of its family.
SHARED, FAMILY = 9, 5
#: Depths of an edge, or marks of a path, that are handled together.
BLOCK = 1024
#: Prefixes kept in one row.
CHUNK = 256
#: The first batch is one in so many sequences.
SHARE = 16
#: Steps of the binary search planned as one job.
STEPS = 4
#: Ids joined in one piece of a digest.
PIECE = 4096

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo 2**64."""
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.copy()
    while left.any():
        out = np.where(left & 1, out * np.uint64(square), out)
        square, left = square * square % 2**64, left >> 1
    return out


def _terms(batches):
    """Hashes of turns weighed by their depth, so that prefixes are sums."""
    for batch in batches:
        depth = batch.column("d").to_numpy(zero_copy_only=False)
        names = batch.schema.names
        columns = [batch.column(n) for n in names]
        for name, base in zip(("k1", "k2"), _BASES, strict=True):
            term = batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64) * _power(base, depth)
            columns[names.index(name)] = pa.array(term.view(np.int64))
        yield pa.RecordBatch.from_arrays(columns, names=names)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from a shared beginning: turns ``c, d, k1, k2, size`` and ``c, len`` of all.

    Conversation c becomes the first h original turns of conversation c - c % 5 (all if it has fewer, none
    if it is absent), then its own turns after its first h; h = crc32(decimal c) % 9. ``k1, k2`` are
    hashes of (role, text), ``size`` the UTF-8 bytes of the text.
    """
    role, text = (F.coalesce(F.col(k).cast("string"), F.lit("")) for k in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"),
        "turn",
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(text, F.lit(1), role).alias("k2"),
        F.octet_length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    turns = running(turns, "c", order, ["row"], "turns").drop("turn")
    own = turns.groupBy("c").agg(F.max("row").alias("own"))
    own = own.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).withColumn("base", F.col("c") - F.col("c") % FAMILY)
    convs = own.join(own.select(F.col("c").alias("base"), F.col("own").alias("theirs")), "base", "left")
    convs = convs.withColumn("m", F.least("h", F.coalesce("theirs", F.lit(0).cast("long"))))
    convs = saved(convs.select("c", "base", "h", "m", (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")), "convs")
    rest = turns.join(convs.select("c", "h", "m"), "c").where("row > h").withColumn("d", F.col("m") + F.col("row") - F.col("h"))
    heads = turns.where(F.col("row") < SHARED).withColumnRenamed("c", "base").join(convs.select("base", "c", "m"), "base").where("row <= m").withColumn("d", F.col("row"))
    columns = ["c", "d", "k1", "k2", "size"]
    return rest.select(columns).unionByName(heads.select(columns)), convs.select("c", "len")


def _fattest(low: str, high: str) -> str:
    """SQL of the number in (low, high] that is divisible by the largest power of two."""
    bits = f"(length(bin({low} ^ {high})) - 1)"
    return f"shiftleft(shiftright({high}, {bits}), {bits})"


class Prefixes:
    """Prefixes of distinct sequences, ``CHUNK`` depths a row: ``s, chunk, k1, k2, upto`` (arrays)."""

    def __init__(self, prefixes: DataFrame):
        place = F.floor((F.col("d") - 1) / CHUNK).cast("long")
        rows = prefixes.groupBy("s", place.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("d", "k1", "k2", "upto"))).alias("x"))
        self.chunks = saved(rows.select("s", "chunk", *(F.col("x").getField(n).alias(n) for n in ("k1", "k2", "upto"))), "prefixes")

    def at(self, frame: DataFrame, who: str, depth, **names: str) -> DataFrame:
        """``frame`` with values of sequence ``who`` at a depth under new names; null where there is none."""
        chunk, within = F.floor((depth - 1) / CHUNK).cast("long"), (F.pmod(depth - 1, F.lit(CHUNK)) + 1).cast("int")
        mine = self.chunks.select(F.col("s").alias("_s"), F.col("chunk").alias("_chunk"), *(F.col(n).alias(f"_{n}") for n in names))
        joined = frame.withColumns({"_at": F.when(depth > 0, chunk), "_within": within})
        joined = joined.join(mine, (F.col(who) == F.col("_s")) & (F.col("_at") == F.col("_chunk")), "left")
        found = {new: F.try_element_at(F.col(f"_{n}"), F.col("_within")) for n, new in names.items()}
        return joined.withColumns(found).drop("_at", "_within", "_s", "_chunk", *(f"_{n}" for n in names))

    def shared(self, pairs: DataFrame, one: str, other: str, low: str, high: str) -> DataFrame:
        """``one, more`` for pairs of sequences that are equal up to depth ``low``: how many depths more, up to ``high``."""
        spans = pairs.where(f"{low} < {high}").select(one, other, low, high)
        blocks = spans.withColumn("chunk", F.explode(F.sequence(F.floor(F.col(low) / CHUNK), F.floor((F.col(high) - 1) / CHUNK))))
        for who, name in ((one, "a"), (other, "b")):
            mine = self.chunks.select(F.col("s").alias(who), "chunk", F.col("k1").alias(f"{name}1"), F.col("k2").alias(f"{name}2"))
            blocks = blocks.join(mine, [who, "chunk"])
        depths = F.sequence(F.greatest(F.col(low) - F.col("chunk") * CHUNK, F.lit(0)), F.least(F.col(high) - F.col("chunk") * CHUNK, F.lit(CHUNK)) - 1)
        equal = F.filter(depths, lambda i: (F.get("a1", i) == F.get("b1", i)) & (F.get("a2", i) == F.get("b2", i)))
        return blocks.select(one, F.size(equal).alias("equal")).groupBy(one).agg(F.sum("equal").alias("more"))


class Trie:
    """The compacted trie of distinct sequences.

    ``sequences``: ``s, len, k1, k2, total, n``. After ``build``: ``paths`` (``s, x, onto``: path s leaves path ``onto`` at
    depth x; the root is depth 0 of no path) and ``nodes`` (``r, e, p``: the node at depth e of path r, its edge
    beginning at depth p, with ``f`` and its handle, the prefix of its end and that of its first turn).
    """

    def __init__(self, sequences: DataFrame, prefixes: Prefixes):
        self.sequences, self.prefixes = sequences, prefixes
        self.paths = self.marks = self.nodes = None
        self.rounds = 0

    def build(self) -> Trie:
        # the first batch is a share of the sequences, drawn by a hash; the second finds a trie to search
        first = F.pmod(F.xxhash64("s", F.lit(1)), F.lit(SHARE)) == 0
        for batch in (self.sequences.where(first), self.sequences.where(~first)):
            batch = batch.select("s", "len", F.lit(0).cast("long").alias("x"), F.lit(None).cast("long").alias("onto"))
            if not batch.isEmpty():
                self._insert(batch if self.nodes is None else self._located(batch))
        return self

    def _insert(self, exits: DataFrame) -> None:
        """A batch: where its sequences leave the trie, one of those with the same next turn becomes a path.

        The others follow that path as far as they share it, which is where they leave the trie next.
        """
        paths, marks, state = [], [exits.where("onto is not null and x = len").select(F.col("onto").alias("r"), F.col("x").alias("e"))], exits
        while True:
            state = state.where("x < len")
            going = self.prefixes.at(state, "s", F.col("x") + 1, k1="q1", k2="q2")
            drawn = saved(going.groupBy("q1", "q2").agg(F.min_by("s", F.xxhash64("s")).alias("path")), "drawn")  # one to one
            chosen = drawn.select(F.col("q1").alias("w1"), F.col("q2").alias("w2"), "path")
            joined = saved(going.join(chosen, (F.col("q1") == F.col("w1")) & (F.col("q2") == F.col("w2"))).select("s", "len", "x", "onto", "path"), "joined")
            self.rounds += 1
            new = joined.where("s = path")
            paths.append(new.select("s", "x", "onto"))
            marks += [new.select(F.col("s").alias("r"), F.col("len").alias("e")), new.where("onto is not null").select(F.col("onto").alias("r"), F.col("x").alias("e"))]
            rest = joined.where("s <> path")
            if rest.isEmpty():
                break
            ends = self.sequences.select(F.col("s").alias("path"), F.col("len").alias("path_len"))
            rest = rest.join(ends, "path").select("s", "len", "path", (F.col("x") + 1).alias("low"), F.least("len", "path_len").alias("high"))
            more = self.prefixes.shared(rest, "s", "path", "low", "high")
            state = rest.join(more, "s", "left").select("s", "len", (F.col("low") + F.coalesce("more", F.lit(0))).alias("x"), F.col("path").alias("onto"))
            state = saved(state, "state")
            marks.append(state.where("x = len").select(F.col("onto").alias("r"), F.col("x").alias("e")))
            if state.where("x < len").isEmpty():
                break
        self.paths = saved(reduce(DataFrame.unionByName, paths if self.paths is None else [self.paths, *paths]), "paths")
        marks = reduce(DataFrame.unionByName, marks if self.marks is None else [self.marks, *marks])
        self.marks = saved(marks.distinct().withColumn("block", F.floor(F.col("e") / BLOCK)), "marks")
        # the node before on the path, or the place where the path begins
        inside = self.marks.withColumn("before", F.lag("e").over(Window.partitionBy("r", "block").orderBy("e")))
        tops = self.marks.groupBy("r", "block").agg(F.max("e").alias("top"))
        earlier = tops.withColumn("earlier", F.lag("top").over(Window.partitionBy("r").orderBy("block"))).drop("top")
        nodes = inside.join(earlier, ["r", "block"]).join(self.paths.select(F.col("s").alias("r"), F.col("x").alias("start")), "r")
        nodes = nodes.select("r", "e", F.coalesce("before", "earlier", "start").alias("p")).withColumn("f", F.expr(_fattest("p", "e")))
        at = self.prefixes.at
        nodes = at(at(at(nodes, "r", F.col("f"), k1="h1", k2="h2"), "r", F.col("e"), k1="end1", k2="end2"), "r", F.col("p") + 1, k1="entry1", k2="entry2")
        self.nodes, self.marks = saved(nodes, "nodes"), self.marks.drop("block")

    def _located(self, todo: DataFrame) -> DataFrame:
        """The exit of each sequence from the trie: depth ``x`` of path ``onto``."""
        at = self.prefixes.at
        handles = self.nodes.select(
            F.col("f").alias("hf"), F.col("h1").alias("hh1"), F.col("h2").alias("hh2"), F.col("r").alias("hr"), F.col("e").alias("he")
        )
        nothing = F.lit(None).cast("long")
        state = todo.select("s", "len", F.lit(0).cast("long").alias("lo"), F.col("len").alias("hi"), nothing.alias("r"), nothing.alias("e"), nothing.alias("f"))
        while True:
            for _ in range(STEPS):
                state = state.withColumn("g", F.expr(f"if(lo < hi, {_fattest('lo', 'hi')}, null)"))
                state = at(state, "s", F.col("g"), k1="g1", k2="g2")
                state = state.join(handles, (F.col("g") == F.col("hf")) & (F.col("g1") == F.col("hh1")) & (F.col("g2") == F.col("hh2")), "left")
                hit = F.col("hr").isNotNull()
                state = state.select(
                    "s", "len",
                    F.when(hit, F.col("he")).otherwise(F.col("lo")).alias("lo"),
                    F.when(hit | F.col("g").isNull(), F.col("hi")).otherwise(F.col("g") - 1).alias("hi"),
                    F.coalesce("hr", "r").alias("r"), F.coalesce("he", "e").alias("e"), F.when(hit, F.col("g")).otherwise(F.col("f")).alias("f"),
                )
            state = saved(state, "search")
            if state.where("lo < hi").isEmpty():
                break
        # the last hit is passed if the sequence has its whole prefix; then an edge below may begin with the next turn
        ends = self.nodes.select(F.col("r").alias("nr"), F.col("e").alias("ne"), "end1", "end2")
        state = at(state, "s", F.col("e"), k1="own1", k2="own2").join(ends, (F.col("r") == F.col("nr")) & (F.col("e") == F.col("ne")), "left")
        passed = F.coalesce((F.col("own1") == F.col("end1")) & (F.col("own2") == F.col("end2")), F.lit(False))
        state = state.withColumns({"within": F.col("r").isNotNull() & ~passed, "x": F.when(passed, F.col("e")).otherwise(0)})
        entries = self.nodes.select(F.col("p").alias("np"), F.col("entry1").alias("ne1"), F.col("entry2").alias("ne2"), F.col("r").alias("below"), F.col("e").alias("below_e"))
        state = at(state, "s", F.when(~F.col("within"), F.col("x") + 1), k1="next1", k2="next2")
        state = state.join(entries, (F.col("x") == F.col("np")) & (F.col("next1") == F.col("ne1")) & (F.col("next2") == F.col("ne2")), "left")
        state = state.select(
            "s", "len",
            F.when(F.col("within"), F.col("r")).otherwise(F.col("below")).alias("edge"),
            F.when(F.col("within"), F.col("f")).when(F.col("below").isNotNull(), F.col("x") + 1).otherwise(F.col("x")).alias("low"),
            F.least("len", F.when(F.col("within"), F.col("e")).otherwise(F.col("below_e"))).alias("high"),
            F.when(~F.col("within"), F.col("r")).alias("node"),
        )
        state = saved(state, "edges")
        # along the edge, prefixes are equal up to the place where the sequence leaves it
        more = self.prefixes.shared(state.where("edge is not null"), "s", "edge", "low", "high")
        return saved(state.join(more, "s", "left").select(
            "s", "len", (F.col("low") + F.coalesce("more", F.lit(0))).alias("x"), F.coalesce("edge", "node").alias("onto"),
        ), "located")


def _pieces(batches):
    """Runs of ids of one group joined into strings of at most ``PIECE`` ids."""
    group, ids, out = None, [], []

    def close():
        if ids:
            out.append((group, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def taken():
        s, first, text = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["s", "first_id", "piece"])

    for batch in batches:
        for s, c in zip(batch.column("s").to_pylist(), batch.column("c").to_pylist(), strict=True):
            if s != group or len(ids) >= PIECE:
                close()
                group = s
            ids.append(c)
        if len(out) > 1000:
            yield taken()
    close()
    if out:
        yield taken()


def _digests(batches):
    """sha256 of each group's pieces in order, piece by piece."""
    group, digest = None, None
    for batch in batches:
        out = []
        for s, piece in zip(batch.column("s").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if s != group:
                if digest is not None:
                    out.append((group, digest.hexdigest()))
                group, digest = s, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])], names=["s", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([digest.hexdigest()])], names=["s", "ends_sha256"])


def id_digests(members: DataFrame) -> DataFrame:
    """``s, ends_sha256`` of the ascending ids ``c`` of each group ``s``, joined by commas."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = members.select("s", "c").repartitionByRange(n, "s", "c").sortWithinPartitions("s", "c").mapInArrow(_pieces, "s long, first_id long, piece string")
    return pieces.repartition(n, "s").sortWithinPartitions("s", "first_id").select("s", "piece").mapInArrow(_digests, "s long, ends_sha256 string")


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _rows(frame: DataFrame, rows: list) -> DataFrame:
    return frame.sparkSession.createDataFrame(rows, NODE)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, the empty one included.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of its subtree), ``saved_tokens`` (over its subtree: members but one, times
    the bytes of the node's last text), ``ends_sha256`` (ids of the members that end here).
    """
    turns, convs = rebuilt(conversations)
    turns = turns.mapInArrow(_terms, turns.schema).withColumn("row", F.lit(1).cast("long"))
    prefixes = saved(running(turns, "c", [F.col("d")], ["k1", "k2", "size", "row"], "sums").drop("row").withColumnRenamed("size", "upto"), "prefixes")
    ends = convs.join(prefixes.select("c", F.col("d").alias("len"), "k1", "k2", "upto"), ["c", "len"], "left")
    ends = saved(ends.select("c", "len", F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2"), F.coalesce("upto", F.lit(0)).alias("total")), "ends")
    kinds = ends.groupBy("len", "k1", "k2").agg(F.min("c").alias("s"), F.count("*").alias("n"), F.max("total").alias("total"))
    kinds = saved(kinds, "kinds")
    whole = convs.agg(F.min("c").alias("low"), F.count("*").alias("n")).first()
    sequences = kinds.where("len > 0")
    prefixes = Prefixes(prefixes.join(sequences.select("s"), F.col("c") == F.col("s"), "left_semi").withColumnRenamed("c", "s"))
    trie = Trie(sequences, prefixes).build() if not sequences.isEmpty() else None

    # digests of the members that end with each sequence; a single id needs no order
    members = ends.join(kinds.where("n > 1").select("s", "len", "k1", "k2"), ["len", "k1", "k2"]).select("s", "c")
    one = kinds.where("n = 1").select("s", F.sha2(F.col("s").cast("string").cast("binary"), 256).alias("ends_sha256"))
    digests = one.unionByName(id_digests(members))
    nothing = hashlib.sha256(b"").hexdigest()
    if whole.n == 0:
        return _rows(conversations, [])
    turnless = kinds.where("len = 0").join(digests, "s").select("ends_sha256").first()
    root = [whole.low, 0, None, whole.n, 0, 1, 0, turnless.ends_sha256 if turnless else nothing]
    if trie is None:
        return _rows(conversations, [root])

    paths, nodes = trie.paths, trie.nodes.select("r", "e", "p", F.col("end1").alias("k1"), F.col("end2").alias("k2"))
    def bytes_at(frame: DataFrame, who: str, depth, name: str) -> DataFrame:
        return prefixes.at(frame, who, depth, upto=name).withColumn(name, F.coalesce(name, F.lit(0).cast("long")))

    # what each sequence brings: its copies, the bytes of its own edges, and whether its path ends in a leaf
    branches = saved(paths.groupBy(F.col("onto").alias("r"), F.col("x").alias("e")).agg(F.count("*").alias("branches")), "branches")
    own = bytes_at(sequences.join(paths.select("s", "x"), "s", "left"), "s", F.col("x"), "before")
    own = own.join(branches.select(F.col("r").alias("s"), F.col("e").alias("len"), "branches"), ["s", "len"], "left")
    own = saved(own.select(
        "s", "n", "total", (F.col("n") * F.col("total")).alias("all_bytes"),
        F.when(F.col("x").isNotNull(), F.col("total") - F.col("before")).otherwise(0).alias("own_bytes"),
        (F.col("x").isNotNull() & F.col("branches").isNull()).cast("long").alias("leaf"),
    ), "own")

    # members of each node: the sequences that have its prefix
    turn = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("k1")).alias("i"), F.col("k1"), F.col("k2"))).alias("t")
    passing = prefixes.chunks.select("s", "chunk", turn).select("s", (F.col("chunk") * CHUNK + F.col("t.i")).alias("e"), "t.k1", "t.k2")
    passing = passing.join(nodes.select("r", "e", "k1", "k2"), ["e", "k1", "k2"]).select("r", "e", "s")
    stats = passing.join(own.drop("total"), "s").groupBy("r", "e").agg(
        F.min("s").alias("low"), F.sum("n").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum("all_bytes").alias("all_bytes"), F.sum("own_bytes").alias("own_bytes")
    )
    mine = own.select(F.col("s").alias("r"), F.col("total").alias("path_bytes"), F.col("own_bytes").alias("path_own"))
    long_paths = paths.join(sequences.select("s", "len"), "s").select(F.col("s").alias("r"), "x", "onto", "len")
    stats = bytes_at(stats.join(nodes.select("r", "e", "p", "k1", "k2"), ["r", "e"]).join(mine, "r").join(long_paths, "r"), "r", F.col("e") - 1, "above")
    stats = stats.join(branches, ["r", "e"], "left")
    ending = sequences.select("s", F.col("len").alias("e"), "k1", "k2").join(digests, "s").drop("s")
    stats = stats.join(ending, ["e", "k1", "k2"], "left")
    saves = F.col("all_bytes") - F.col("n_convs") * F.col("above") - (F.col("own_bytes") - F.col("path_own") + F.col("path_bytes") - F.col("above"))
    stats = saved(stats.select(
        "r", "e", "p", "low", "n_convs", "n_leaves", "above", saves.alias("saved_tokens"),
        (F.coalesce("branches", F.lit(0).cast("long")) + (F.col("e") < F.col("len")).cast("long")).alias("n_children"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        F.when(F.col("p") > F.col("x"), F.col("r")).otherwise(F.col("onto")).alias("parent_path"),
    ), "stats")
    parents = stats.select(F.col("r").alias("parent_path"), F.col("e").alias("p"), F.col("low").alias("parent_low"))
    stats = stats.join(parents, ["parent_path", "p"], "left").withColumn("parent_low", F.when(F.col("p") == 0, F.lit(whole.low)).otherwise(F.col("parent_low")))

    # edges expanded, in blocks of depths
    blocks = stats.withColumn("from", F.explode(F.sequence(F.col("p") + 1, F.col("e"), F.lit(BLOCK))))
    expanded = blocks.withColumn("depth", F.explode(F.sequence(F.col("from"), F.least(F.col("e"), F.col("from") + BLOCK - 1))))
    expanded = bytes_at(expanded, "r", F.col("depth") - 1, "before")
    last = F.col("depth") == F.col("e")
    expanded = expanded.select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("p") + 1, F.col("parent_low")).otherwise(F.col("low")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * (F.col("above") - F.col("before"))).alias("saved_tokens"),
        F.when(last, F.col("ends_sha256")).otherwise(F.lit(nothing)).alias("ends_sha256"),
    )

    sums = own.agg(F.sum("leaf").alias("leaves"), (F.sum("all_bytes") - F.sum("own_bytes")).alias("saves")).first()
    root[4:7] = paths.where("x = 0").count(), sums.leaves, sums.saves
    return _rows(conversations, [root]).unionByName(expanded)


#: The same rows in SQL: every prefix as a list, and each node added to all of its ancestors.
ORACLE = """
WITH convs AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), bits AS (
  -- crc32 of the decimal id, bit by bit
  SELECT *, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: list_transform(range(8), lambda i: ((ascii(x)::BIGINT >> i) & 1)::BIGINT)))::BIGINT[] AS bit FROM convs
), hashed AS (
  SELECT c, own, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, bit),
    lambda crc, b: xor(crc::BIGINT >> 1, CASE WHEN (crc::BIGINT & 1) <> b THEN 3988292384::BIGINT ELSE 0::BIGINT END))) % 9 AS h FROM bits
), seqs AS (
  SELECT x.c, list_concat(list_slice(coalesce(y.own, []), 1, x.h), list_slice(x.own, x.h + 1, len(x.own))) AS seq
  FROM hashed x LEFT JOIN convs y ON y.c = x.c - x.c % 5
), members AS (
  SELECT c, len(seq) AS n, unnest(range(len(seq) + 1)) AS depth, seq FROM seqs
), nodes AS (
  SELECT list_slice(seq, 1, depth) AS prefix, depth, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '') AS ends
  FROM members GROUP BY ALL
), children AS (
  SELECT list_slice(prefix, 1, depth - 1) AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON n.depth = k.depth AND n.prefix = k.prefix
), above AS (
  SELECT list_slice(prefix, 1, d) AS prefix, d AS depth, sum((n_children = 0)::INT) AS n_leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(prefix[depth].t) END) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves::BIGINT AS n_leaves,
  a.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN above a ON a.depth = n.depth AND a.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""
