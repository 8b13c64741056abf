"""Near-duplicate embeddings: tiles in PCA order, compared leading dimensions first.

Vectors are scaled to length one and rotated onto the principal axes of the whole table (a sum of
outer products, one matrix from each task). A tree of cuts along the leading axes, fitted on a
bounded sample, deals the vectors into cells; a cell with more than ``TILE`` vectors is cut further
by a hash of the vector, so no tile grows with a hot spot. Consecutive tiles are written as one packed row, a
pack. Packs meet in a Cartesian product that reads their files again and shuffles nothing: what is written
grows with the table, however many tiles meet, and only what is read and compared grows with the meetings.

Two unit vectors with cosine >= t are at most sqrt(2 - 2t) apart, so two tiles meet only if the boxes of
their cells along the leading axes come that close. Where tiles meet, products are summed over blocks of
leading axes; after each block the rest is bounded by the product of the suffix norms, and a pair stops as
soon as it cannot reach t. The first block is the one that is cheapest on the sample, and its bound is one matrix
product in single precision, with the suffix norms as one more axis and a margin for rounding. Pairs near the threshold
are decided on the given components in double precision. A Python worker holds two packs at a time; it
emits counts of links and a spanning forest of them, never the pairs. Vectors are kept in single precision where that
holds all their components, and later joins know them by their SHA-256.

Vectors without structure along few axes (as random ones) are far from all cells' borders' reach: then every
tile meets every other, which costs a few nanoseconds a pair and grows with the square of the table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import components, forget, saved

TILE = 2048
SAMPLE = 4096
DEPTH = 10  # at most 1,024 cells; larger cells are cut by hash
BLOCKS = (8, 16, 24, 32, 48)
AXES = 8  # leading axes of cuts and boxes
VISITORS = 32  # consecutive tiles that visit others together, as one pack, at most
PACK = 16 << 20  # bytes of a pack's vectors as doubles, unless one tile has more
PACKS = 24  # packs that a table has at least if it has as many tiles, so that there is work for all cores
MEETINGS = 20_000  # tasks of the product of packs at most
NEAR = 1e-9
#: Bound on the rounding of a product of unit vectors in single precision.
ROUNDING = 2e-5
#: What a pair that survives the first block costs, in axes of a pair in it (some 700 and 0.04 nanoseconds).
SURVIVOR = 16_000


def _coded(x: np.ndarray) -> bytes:
    """A vector in single precision if that holds all its components; equal vectors give equal bytes."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return (single if (single == x).all() else x).tobytes()


def _decoded(parts: list[bytes], width: int) -> np.ndarray:
    """Rows of doubles, of vectors of one length as ``_coded`` gives them."""
    single = np.fromiter(map(len, parts), np.int64, len(parts)) == 4 * width
    out = np.empty((len(parts), width))
    for kind, where in ((np.float32, single), (np.float64, ~single)):
        if where.any():
            out[where] = np.frombuffer(b"".join(p for p, ok in zip(parts, where, strict=True) if ok), kind).reshape(-1, width)
    return out


def _matrix(column, width: int) -> np.ndarray:
    return _decoded(column.to_pylist(), width)


def _valid(batches):
    """Usable vectors as binary rows, and their lengths."""
    for batch in batches:
        ids, width, out = [], [], []
        for key, value in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            if key is None or value is None or None in value:
                continue
            x = np.array(value, np.float64) + 0.0  # -0.0 and 0.0 are one value
            if np.isfinite(x).all() and x.any():
                ids.append(key)
                width.append(len(x))
                out.append(_coded(x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(width, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "width", "vec"])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(width: int):
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                u = unit(_matrix(batch.column("vec").slice(at, 4096), width))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([r.tobytes() for r in total], pa.binary())], names=["axis", "row"])

    return run


def _row_sums(key, table):
    total = np.sum([np.frombuffer(r, np.float64) for r in table.column("row").to_pylist()], axis=0)
    return pa.table({"axis": pa.array([key[0].as_py()], pa.int64()), "row": pa.array([total.tobytes()], pa.binary())})


def principal_axes(nodes: DataFrame, width: int) -> np.ndarray:
    """Columns: principal axes of the unit vectors, the strongest first. A matrix a task is summed row by row."""
    rows = nodes.select("vec").mapInArrow(_moments(width), "axis long, row binary").groupBy("axis").applyInArrow(_row_sums, "axis long, row binary")
    moment = np.zeros((width, width))
    for r in rows.collect():
        moment[r["axis"]] = np.frombuffer(r["row"], np.float64)
    return np.linalg.eigh(moment)[1][:, ::-1].copy()


class Cells:
    """Binary cuts along leading principal axes; a leaf is a cell."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.cuts: list[tuple[int, float] | None] = []  # node k has children 2k+1 and 2k+2
        axes = min(AXES, sample.shape[1])
        parts = [sample]
        for _ in range(depth):
            below = []
            for part in parts:
                if len(part) < 4:
                    self.cuts.append((0, 0.0))
                    below += [part, part]
                    continue
                spread = np.quantile(part[:, :axes], [0.1, 0.9], axis=0)
                axis = int(np.argmax(spread[1] - spread[0]))
                cut = float(np.median(part[:, axis]))
                self.cuts.append((axis, cut))
                below += [part[part[:, axis] < cut], part[part[:, axis] >= cut]]
            parts = below
        self.depth = depth

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        node = np.zeros(len(x), np.int64)
        axis = np.array([c[0] for c in self.cuts] or [0])
        cut = np.array([c[1] for c in self.cuts] or [0.0])
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), axis[node]] >= cut[node])
        return node - (2**self.depth - 1)


def _rest(x: np.ndarray, k: int) -> np.ndarray:
    return np.sqrt((x[:, k:] ** 2).sum(axis=1))


def _leading(x: np.ndarray, k: int) -> np.ndarray:
    """The first k axes and the norm of the rest, in single precision: the product of two such rows bounds the cosine."""
    return np.column_stack([x[:, :k], _rest(x, k)]).astype(np.float32)


def first_block(sample: np.ndarray, least: float) -> int:
    """How many axes are best taken at once: their cost and that of the sampled pairs that survive them."""
    width = sample.shape[1]
    ends = [e for e in BLOCKS if e < width] + [width]
    a, b = sample[: len(sample) // 2][:512], sample[len(sample) // 2 :][:512]
    if not len(a):
        return ends[0]
    share = [float((_leading(a, k) @ _leading(b, k).T >= least - ROUNDING).mean()) for k in ends]
    return min(zip(ends, share, strict=True), key=lambda x: x[0] + SURVIVOR * x[1])[0]


def linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, head_a: np.ndarray, head_b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rotated unit rows with cosine >= ``least``; heads are their ``_leading`` rows."""
    width, first = a.shape[1], head_a.shape[1] - 1
    ends = [e for e in (*BLOCKS, width) if first <= e < width] + [width]
    i, j = [], []
    for at in range(0, len(b), 1024):
        near = head_a @ head_b[at : at + 1024].T >= least - ROUNDING
        x, y = np.divmod(np.flatnonzero(near), near.shape[1])  # much faster than nonzero() of the matrix
        i.append(x)
        j.append(y + at)
    i, j = np.concatenate(i), np.concatenate(j)
    keep_i, keep_j = [], []
    for at in range(0, len(i), 1 << 16):  # bounded slices of the surviving pairs
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        part = np.einsum("ij,ij->i", a[p, :first], b[q, :first])
        for start, end in zip(ends, ends[1:], strict=False):
            part += np.einsum("ij,ij->i", a[p, start:end], b[q, start:end])
            ok = part + _rest(a[p], end) * _rest(b[q], end) >= least - NEAR
            p, q, part = p[ok], q[ok], part[ok]
        close = np.flatnonzero(np.abs(part - least) <= NEAR)
        if len(close):
            x, y = raw_a[p[close]], raw_b[q[close]]
            x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
            dot = (x * y).sum(axis=1) / (np.sqrt((x**2).sum(axis=1)) * np.sqrt((y**2).sum(axis=1)))
            part[close] = np.where(dot >= least, 2.0, -2.0)
        ok = part >= least
        keep_i.append(p[ok])
        keep_j.append(q[ok])
    if not keep_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keep_i), np.concatenate(keep_j)


class Grid:
    """Cells, their tiles and packs of tiles: how many, where their numbers begin, and which cells' boxes come close."""

    def __init__(self, cells: Cells, rows: list, reach: float, dims: int):
        """``rows``: cell, count, lowest and highest place along the leading axes. ``dims``: components of a vector."""
        self.cells = cells
        n = 2**cells.depth
        count = np.zeros(n, np.int64)
        width = len(rows[0][2]) if rows else 1
        low, high = np.full((n, width), np.inf), np.full((n, width), -np.inf)
        for cell, size, lo, hi in rows:
            count[cell], low[cell], high[cell] = size, lo, hi
        self.blocks = -(-count // TILE)
        self.base = np.concatenate([[0], np.cumsum(self.blocks)])
        self.near = np.zeros((n, n), bool)
        for c in np.flatnonzero(count):
            gap = np.maximum(np.maximum(low - high[c], low[c] - high), 0)
            self.near[c] = (count > 0) & ((gap**2).sum(axis=1) <= reach**2 + NEAR)
        self.n_tiles = int(self.base[-1])
        largest = int((count / np.maximum(self.blocks, 1)).max())
        self.together = max(1, min(VISITORS, PACK // max(1, 8 * dims * largest), self.n_tiles // PACKS))
        self.n_packs = max(1, -(-self.n_tiles // self.together))

    def tile(self, cell: np.ndarray, node: np.ndarray) -> np.ndarray:
        return self.base[cell] + (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % np.maximum(self.blocks[cell], 1)

    def cell_of(self, tiles: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, tiles, side="right") - 1

    def receives(self, pack: int) -> np.ndarray:
        """The packs that are compared with one: itself, and half of those with tiles that may have links with its own."""
        own = np.arange(pack * self.together, min(self.n_tiles, (pack + 1) * self.together))
        cells = np.flatnonzero(self.near[np.unique(self.cell_of(own))].any(axis=0))
        found = [np.arange(self.base[c] // self.together, (self.base[c + 1] - 1) // self.together + 1) for c in cells]
        others = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        others = others[others != pack]
        # of two packs, one receives the other: the higher one if their sum is even
        return np.concatenate([[pack], others[((pack + others) % 2 == 0) == (pack > others)]])


def _cell_ends(width: int, axes: np.ndarray, cells: Cells):
    """Count and box of each cell, of a task's vectors."""
    k = min(AXES, width)

    def run(batches):
        n = 2**cells.depth
        count, low, high = np.zeros(n, np.int64), np.full((n, k), np.inf), np.full((n, k), -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = unit(_matrix(batch.column("vec").slice(at, 4096), width)) @ axes
                home = cells.of(x)
                count += np.bincount(home, minlength=n)
                np.minimum.at(low, home, x[:, :k])
                np.maximum.at(high, home, x[:, :k])
        got = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(got), pa.array(count[got]), *(pa.array(v[got, i]) for v in (low, high) for i in range(k))],
            names=["cell", "n", *(f"{name}{i}" for name in ("low", "high") for i in range(k))],
        )

    return run


def _homes(width: int, axes: np.ndarray, grid: Grid):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = unit(_matrix(part.column("vec"), width)) @ axes
                node = part.column("node").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(grid.tile(grid.cells.of(x), node)), part.column("node"), part.column("vec"), part.column("copies")], names=["tile", "node", "vec", "copies"])

    return run


COLUMNS = ["pack", "tiles", "nodes", "copies", "vecs"]
PACKED = "pack long, receives array<long>, tiles binary, nodes binary, copies binary, vecs binary"


def _packed(width: int, grid: Grid):
    """Each pack as one row, with the tile of each vector; rows come tile by tile."""

    def row(pack, held):
        tiles, nodes, copies, vecs = zip(*held, strict=True)
        vecs = [v for part in vecs for v in part]
        if any(len(v) != 4 * width for v in vecs):
            vecs = [_decoded(vecs, width).tobytes()]
        parts = (b"".join(x) for x in (tiles, nodes, copies, vecs))
        receives = pa.array([grid.receives(pack)], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([pack], pa.int64()), receives, *(pa.array([x], pa.binary()) for x in parts)], names=["pack", "receives", *COLUMNS[1:]])

    def run(batches):
        at, held = None, []
        for batch in batches:
            packs = batch.column("tile").to_numpy(zero_copy_only=False) // grid.together
            edges = np.flatnonzero(np.diff(packs, prepend=packs[:1] - 1)) if len(packs) else []
            for lo, hi in zip(edges, [*edges[1:], len(packs)], strict=True):
                if held and packs[lo] != at:
                    yield row(at, held)
                    held = []
                at = int(packs[lo])
                part = batch.slice(lo, hi - lo)
                numbers = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for k in ("tile", "node", "copies"))
                held.append((*numbers, part.column("vec").to_pylist()))
        if held:
            yield row(at, held)

    return run


class Pack:
    """A pack of tiles, opened: vectors as given, rotated and their leading rows, and the links counted so far."""

    def __init__(self, batch, r: int, prefix: str, width: int, axes: np.ndarray, first: int):
        held = {k: np.frombuffer(batch.column(prefix + k)[r].as_buffer(), np.int64) for k in ("tiles", "nodes", "copies")}
        vecs = batch.column(f"{prefix}vecs")[r].as_buffer()
        self.number = batch.column(f"{prefix}pack")[r].as_py()
        self.nodes, self.copies = held["nodes"].copy(), held["copies"].astype(float)
        kind = np.float32 if vecs.size == 4 * width * len(self.nodes) else np.float64
        self.raw = np.frombuffer(vecs, kind).reshape(-1, width).astype(np.float64)
        self.x = unit(self.raw) @ axes
        self.head = _leading(self.x, first)
        self.tiles, start = np.unique(held["tiles"], return_index=True)
        self.slices = [slice(a, b) for a, b in zip(start, [*start[1:], len(self.nodes)], strict=True)]
        self.n_links = np.zeros(len(self.nodes), np.int64)

    def links(self, other: Pack, p: int, q: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the linked vectors of tile ``p`` and of the other pack's tile ``q``; both packs count them."""
        a, b = self.slices[p], other.slices[q]
        i, j = linked(self.x[a], other.x[b], self.raw[a], other.raw[b], self.head[a], other.head[b], least)
        if self is other and p == q:
            apart = i < j
            i, j = i[apart], j[apart]
        i, j = i + a.start, j + b.start
        self.n_links += np.bincount(i, other.copies[j], len(self.nodes)).astype(np.int64)
        other.n_links += np.bincount(j, self.copies[i], len(other.nodes)).astype(np.int64)
        return i, j

    def counted(self) -> pa.RecordBatch:
        """The links counted so far, a row a vector that has some."""
        found = np.flatnonzero(self.n_links)
        return _found(0, self.nodes[found], self.n_links[found])


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 0, a node and a number of links, or 1, a link."""
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])


def _compare(width: int, axes: np.ndarray, grid: Grid, least: float, first: int):
    """Rows are two packs that meet, mostly the same first one as in the row before."""

    def run(batches):
        own = None
        for batch in batches:
            for r in range(batch.num_rows):
                if own is None or own.number != batch.column("pack")[r].as_py():
                    if own is not None:
                        yield own.counted()
                    own = Pack(batch, r, "", width, axes, first)
                other = own if own.number == batch.column("v_pack")[r].as_py() else Pack(batch, r, "v_", width, axes, first)
                near = grid.near[np.ix_(grid.cell_of(own.tiles), grid.cell_of(other.tiles))]
                forest = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                for p, q in zip(*np.nonzero(np.triu(near) if other is own else near), strict=True):
                    i, j = own.links(other, p, q, least)
                    if len(i):
                        forest.append(_forest(own.nodes[i], other.nodes[j]))
                yield _found(1, *_forest(*map(np.concatenate, zip(*forest, strict=True))))
                if other is not own:
                    yield other.counted()
        if own is not None:
            yield own.counted()

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars ``(node, smallest node)`` with the same components as the links ``(a, b)``."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[label]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[out], nodes[label[out]]


def near_vectors(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """Links of cosine >= ``least``: ``vec_id, n_links, component_id, kept``, a row per vector.

    Reads ``vec_id`` and ``embedding`` (an array of numbers); other columns are ignored. Vectors that
    are null, zero or hold a null or non-finite component link with nothing. Vectors of different lengths
    have no cosine: each length (there are few) is compared on its own, with its own axes and tiles. Equal vectors are one node with a multiplicity, so a large group of copies
    costs one comparison. Rows without an id link with nothing, have a null component and are kept.
    Repeated ids count as separate vectors, their links adding up. An empty table gives no rows.
    """
    every = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    usable = saved(every.mapInArrow(_valid, "vec_id long, width int, vec binary"), "vectors")
    widths = [r[0] for r in usable.groupBy("width").count().where("count > 1").orderBy("width").collect()]
    if not widths:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    linked_rows = reduce(DataFrame.unionByName, [_linked_rows(usable.where(F.col("width") == w).drop("width"), w, least) for w in widths])
    ids = linked_rows.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = every.select("vec_id").join(ids, "vec_id", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _digest(column: str):
    """SHA-256 of a vector's bytes."""
    return F.unhex(F.sha2(F.col(column), 256))


def _linked_rows(usable: DataFrame, width: int, least: float) -> DataFrame:
    """``vec_id, n_links, component_id`` of usable vectors of one length, a row each."""
    distinct = usable.groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    # nodes are vectors, numbered, so that ids that repeat name nothing
    nodes = saved(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    axes = principal_axes(nodes, width)

    total = nodes.count()
    taken = nodes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").collect()
    sample = unit(_decoded([bytes(r[0]) for r in taken], width)) @ axes if taken else np.empty((0, width))
    cells = Cells(sample, min(DEPTH, max(0, int(np.ceil(np.log2(max(total, 1) / TILE))))) if len(sample) else 0)

    k = min(AXES, width)
    ends = [f"{name}{i}" for name in ("low", "high") for i in range(k)]
    spec = "cell long, n long, " + ", ".join(f"{c} double" for c in ends)
    boxes = nodes.select("vec").mapInArrow(_cell_ends(width, axes, cells), spec).groupBy("cell")
    boxes = boxes.agg(F.sum("n").alias("n"), *((F.min if c.startswith("low") else F.max)(c).alias(c) for c in ends)).collect()
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    grid = Grid(cells, [(r["cell"], r["n"], [r[f"low{i}"] for i in range(k)], [r[f"high{i}"] for i in range(k)]) for r in boxes], reach, width)

    homes = nodes.select("node", "vec", "copies").mapInArrow(_homes(width, axes, grid), "tile long, node long, vec binary, copies long")
    # a file a pack
    dealt = homes.repartitionById(grid.n_packs, F.expr(f"cast(tile div {grid.together} as int)")).sortWithinPartitions("tile", "node")
    packs = saved(dealt.mapInArrow(_packed(width, grid), PACKED), "packs")
    # both sides are read from these files by each task: nothing is shuffled, however many packs meet
    guests = packs.select(*(F.col(c).alias(f"v_{c}") for c in COLUMNS)).coalesce(grid.n_packs)
    hosts = packs.coalesce(max(1, MEETINGS // grid.n_packs))
    met = hosts.hint("shuffle_replicate_nl").join(guests, F.array_contains("receives", F.col("v_pack"))).drop("receives")
    found = saved(met.mapInArrow(_compare(width, axes, grid, least, first_block(sample, least)), "kind int, a long, b long"), "found")
    label = components(found.where("kind = 1").select("a", "b"))
    more = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))

    own = nodes.select("node", _digest("vec").alias("key"), "first_id", "copies").join(more, "node", "left").join(label, "node", "left")
    own = saved(own.select("key", "first_id", "copies", "others", F.coalesce("component", "node").alias("part")), "parts")
    for done in (nodes, packs, found):
        forget(done)
    smallest = own.groupBy("part").agg(F.min("first_id").alias("component_id"))
    own = own.join(smallest, "part").select(
        "key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return usable.select("vec_id", _digest("vec").alias("key")).join(own, "key").select("vec_id", "n_links", "component_id")
