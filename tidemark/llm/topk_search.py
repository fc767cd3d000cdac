"""Exact top-k inner-product search with cover trees over data and queries.

Every row goes to the cell of its nearest center; the centers are a bounded
sample, the cells' radii are exact over all rows. The rows of a cell are cut into
blocks, each with a cover tree, and neighbouring blocks make up a shard that one
task holds. Queries come in packs, a tree each. A pack and the blocks are walked
together: a pair of nodes is left out when the highest inner product that their
centers and radii allow is below the worst k-th score of any query below the
query node.

Blocks stay where they are, and packs go to them: a pack visits a shard once, and
walks its blocks from the most promising one on, with the scores found so far
carried from block to block. There are three rounds, each with the k-th scores of
the one before as scores to beat: one block of the queries' own cell, the shard of
that cell, and then all shards whose cells may hold a score as high. So at most
packs times shards go over the network, whatever the vectors are like.

What holds of a tree: a node of level i has all its points within 2**i of its
center; its children, of lower levels, have theirs within 2**(i - 1), are more than
2**(i - 1) apart from each other, and the first one has the node's own center. A
node that would need more than ``FANOUT`` children isn't divided: its points are
scanned. Bounds use each node's exact radius, which is at most 2**i.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import materialize, shuffle_partitions

LEAF = 64
FANOUT = 64
#: Rows of a block and queries of a pack, and the most cells of the index.
VECTORS, QUERIES = 4096, 1024
MOST_CELLS = 4096
#: Bytes of the vectors that a task holds at a time.
SHARD_BYTES = 64 << 20


class CoverTree:
    """Nodes in arrays: center, level, radius, children; each node's points are a slice."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.level: list[int | None] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._build(vectors, order, leaf)
        self.order, self.ids, self.vectors = order, ids[order], vectors[order]
        self.centers, self.radii = np.array(self.center), np.array(self.radius)
        self.norms = np.sqrt((self.centers ** 2).sum(1))

    def _build(self, vectors: np.ndarray, order: np.ndarray, leaf: int) -> None:
        """A loop over open slices; ``order`` is permuted so that nodes are slices."""
        todo = [(0, len(order), order[0], -1)]
        while todo:
            a, b, middle, parent = todo.pop()
            node = len(self.center)
            if parent >= 0:
                self.children[parent].append(node)
            points = vectors[order[a:b]]
            center = vectors[middle]
            away = np.sqrt(((points - center) ** 2).sum(1))
            self.center.append(center)
            self.radius.append(float(away.max()))
            self.span.append((a, b))
            self.children.append([])
            self.level.append(math.ceil(math.log2(self.radius[node])) if self.radius[node] else None)
            if b - a <= leaf or self.level[node] is None:
                continue
            # the farthest point that no child covers yet opens another one
            cover = 2.0 ** (self.level[node] - 1)
            centers, nearest, side = [middle], away, np.zeros(b - a, np.int64)
            while len(centers) <= FANOUT and nearest.max() > cover:
                new = order[a + int(nearest.argmax())]
                to_new = np.sqrt(((points - vectors[new]) ** 2).sum(1))
                side = np.where(to_new < nearest, len(centers), side)
                nearest = np.minimum(nearest, to_new)
                centers.append(new)
            if len(centers) > FANOUT:
                continue
            by_side = np.argsort(side, kind="stable")
            order[a:b] = order[a:b][by_side]
            ends = a + np.cumsum(np.bincount(side, minlength=len(centers)))
            for c, lo, hi in zip(centers, np.concatenate([[a], ends[:-1]]).tolist(), ends.tolist()):
                if hi > lo:
                    todo.append((lo, hi, c, node))


def hopeless(most: np.ndarray | float, worst: np.ndarray | float) -> np.ndarray | bool:
    """Whether a bound on scores is below a k-th score; scores are whole numbers."""
    return most + np.abs(most) * 1e-9 + 0.5 < worst


class Best:
    """The k best candidates of each query of a tree so far, in the tree's order."""

    def __init__(self, queries: CoverTree, k: int, least: np.ndarray | None = None):
        n = len(queries.ids)
        self.k, self.queries = k, queries
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        #: What k candidates are known to reach; lower scores need not be found.
        self.least = np.full(n, -np.inf) if least is None else least
        self.worst = self.least.copy()

    def add(self, rows: np.ndarray, named: np.ndarray, got: np.ndarray) -> None:
        """Scores of the candidates ``named`` for some queries, a row each; ties to smaller ids."""
        every = np.concatenate([self.scores[rows], got], 1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(named, got.shape)], 1)
        best = np.lexsort((names, -every), axis=-1)[:, :self.k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(every, best, 1), np.take_along_axis(names, best, 1)
        self.worst[rows] = np.maximum(self.scores[rows, -1], self.least[rows])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, candidate id, score), the best of each query first."""
        found = np.isfinite(self.scores) & (self.scores >= self.least[:, None])
        owner = np.broadcast_to(self.queries.ids[:, None], self.scores.shape)
        return owner[found], self.ids[found], self.scores[found].astype(np.int64)


def bounds(queries: CoverTree, q: list[int], data: CoverTree, d: list[int]) -> np.ndarray:
    """The highest inner products that nodes' centers and radii allow."""
    rq, rd = queries.radii[q][:, None], data.radii[d]
    return queries.centers[q] @ data.centers[d].T + rq * data.norms[d] + rd * queries.norms[q][:, None] + rq * rd


def walk(best: Best, data: CoverTree) -> int:
    """Add what a data tree holds to the best of a query tree; returns how many scores were computed."""
    queries, worst, computed = best.queries, best.worst, 0
    heap = [(-bounds(queries, [0], data, [0]).item(), 0, 0)]
    while heap:
        most, q, d = heapq.heappop(heap)
        a, b = queries.span[q]
        if hopeless(-most, worst[a:b].min()):
            continue
        below_q, below_d = queries.children[q], data.children[d]
        if not below_q and not below_d:
            lo, hi = data.span[d]
            computed += (b - a) * (hi - lo)
            for at in range(lo, hi, 8 * LEAF):  # a node of many points is scanned in parts
                part = slice(at, min(at + 8 * LEAF, hi))
                got = queries.vectors[a:b] @ data.vectors[part].T
                got[queries.ids[a:b, None] == data.ids[None, part]] = -np.inf
                better = np.flatnonzero((got >= worst[a:b, None]).any(1))
                if len(better):
                    best.add(a + better, data.ids[part], got[better])
            continue
        xs, ys = below_q or [q], below_d or [d]
        most = bounds(queries, xs, data, ys)
        low = np.array([worst[lo:hi].min() for lo, hi in map(queries.span.__getitem__, xs)])
        for i, j in zip(*np.nonzero(~hopeless(most, low[:, None]))):
            heapq.heappush(heap, (-most[i, j], xs[i], ys[j]))
    return computed


def search(queries: CoverTree, blocks: list[CoverTree], k: int, worst: np.ndarray | None = None) -> tuple[Best, int]:
    """The k best candidates of all blocks, the most promising block first, and how many scores were computed.

    ``worst`` are scores to beat, in the order that the query tree was built from.
    """
    best, computed = Best(queries, k, None if worst is None else worst[queries.order]), 0
    most = np.array([bounds(queries, [0], b, [0]).item() for b in blocks])
    for at in np.argsort(-most, kind="stable"):
        if not hopeless(most[at], best.worst.min()):
            computed += walk(best, blocks[at])
    return best, computed


# ---- the index ------------------------------------------------------------

def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): components as floor(scale * x); rows without a usable vector go."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), x.alias("x"))
    return rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def by_width(batch: pa.RecordBatch, rows: int = VECTORS) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(width, rows of that width, their vectors as a matrix), ``rows`` at most at a time."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        v = part.column("v")
        widths = np.diff(v.offsets.to_numpy())
        flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        firsts = np.cumsum(widths) - widths
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            yield width, part.take(pa.array(mine)), flat[firsts[mine][:, None] + np.arange(width)]


def sample_centers(rows: DataFrame, most: int = MOST_CELLS) -> dict[int, np.ndarray]:
    """Centers by width: a vector for about every 2,048 rows, ``most`` at most, chosen by a hash of vec_id."""
    n = rows.count()
    wanted = min(most, -(-n // 2048))
    share = int(min(1.0, 2 * wanted / max(n, 1)) * (1 << 30)) + 1
    print_ = F.xxhash64("vec_id", F.lit("center"))
    some = rows.where(F.pmod(print_, F.lit(1 << 30)) < share).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(print_, "vec_id").limit(wanted)
    out: dict[int, list] = {}
    for r in some.collect():
        out.setdefault(len(r["v"]), []).append(r["v"])
    return {w: np.array(v, np.float64).reshape(len(v), w) for w, v in out.items()}


def in_cells(rows: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """(width, cell, away, vec_id, v): each row's nearest center and its distance; the origin's where its width has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, part, matrix in by_width(batch):
                own = centers.get(width, np.zeros((1, width)))
                cell = ((own ** 2).sum(1) - 2 * matrix @ own.T).argmin(1)
                away = np.sqrt(((matrix - own[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), width, np.int32)), pa.array(cell.astype(np.int32)), pa.array(away), *(part.column(c) for c in ("vec_id", "v"))],
                    ["width", "cell", "away", "vec_id", "v"])

    return rows.mapInArrow(run, "width int, cell int, away double, vec_id long, v array<bigint>")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], size: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows of one key, which are sorted by it, ``size`` rows at most."""
    held: list[pa.RecordBatch] = []
    rows, own = 0, None

    def closed() -> Iterator[tuple[tuple, pa.Table]]:
        if held:
            yield own, pa.Table.from_batches(held).combine_chunks()

    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        at = 0
        while at < len(names):
            stop = at
            while stop < len(names) and names[stop] == names[at] and stop - at < size:
                stop += 1
            if own != names[at] or rows + stop - at > size:
                yield from closed()
                held, rows, own = [], 0, names[at]
            held.append(batch.slice(at, stop - at))
            rows += stop - at
            at = stop
    yield from closed()


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    v = table.column("v").combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, width)


def trees(rows: DataFrame, keys: list[str], size: int, by: list[str], carry: str | None = None) -> DataFrame:
    """A tree for up to ``size`` rows of one key: (keys, tree), and the column ``carry`` of its rows in the order of building.

    The rows of a key are sorted by ``by``; ``width`` is one of the keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, table in grouped(batches, keys, size):
            tree = CoverTree(table.column("vec_id").to_numpy(), _matrix(table, own[keys.index("width")]))
            if carry:
                tree.carried = table.column(carry).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int32()) for x in own), pa.array([pickle.dumps(tree)], pa.binary())], [*keys, "tree"])

    placed = rows.repartition(*keys).sortWithinPartitions(*keys, *by)
    return placed.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", tree binary")


@dataclass
class Shards:
    """Of each width: the cells' radii (-1: no rows), and the first and last shard that holds blocks of each cell."""

    radius: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    last: dict[int, np.ndarray]


def in_shards(stats: DataFrame, centers: dict[int, np.ndarray]) -> tuple[DataFrame, Shards]:
    """(width, cell, n_blocks, begin, per_shard), and what queries are compared with.

    A row for each cell, MOST_CELLS and one for each further width. Blocks are
    numbered through the cells of a width, ``per_shard`` of them to a shard.
    """
    rows, begun = [], {}
    out = Shards({}, {}, {})
    for r in sorted(stats.collect(), key=lambda r: (r["width"], r["cell"])):
        width, cell, n = r["width"], r["cell"], -(-r["n"] // (VECTORS * 3 // 4))
        per = max(SHARD_BYTES // (8 * max(width, 1) * VECTORS), 1)
        begin = begun.get(width, 0)
        begun[width] = begin + n
        rows.append((width, cell, n, begin, per))
        for found, value in ((out.radius, r["radius"]), (out.first, begin // per), (out.last, (begin + n - 1) // per)):
            found.setdefault(width, np.full(len(centers.get(width, [0])), -1.0))[cell] = value
    return stats.sparkSession.createDataFrame(rows, "width int, cell int, n_blocks int, begin int, per_shard int"), out


def shard_of(block: Column | str) -> Column:
    at = F.col(block) if isinstance(block, str) else block
    return F.floor((F.col("begin") + at) / F.col("per_shard")).cast("int")


def visited(packs: DataFrame, blocks: DataFrame, k: int, at: list[str]) -> DataFrame:
    """(query_id, vec_id, score): each pack's k best among the blocks of its place, whose columns are ``at``.

    A task holds the blocks of one place at a time, and the packs pass by them.
    """
    kinds = [blocks.select(*at, F.lit(0).alias("kind"), "tree"), packs.select(*at, F.lit(1).alias("kind"), "tree")]
    spark = blocks.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            for *own, kind, tree in zip(*(batch.column(c) for c in (*at, "kind", "tree"))):
                own = [x.as_py() for x in own]
                if own != place:
                    place, held = own, []
                one = pickle.loads(tree.as_py())
                if kind.as_py() == 0:
                    held.append(one)
                elif held:
                    best, _ = search(one, held, k, one.carried)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.result()], ["query_id", "vec_id", "score"])

    placed = kinds[0].unionByName(kinds[1]).repartition(shuffle_partitions(spark), *at).sortWithinPartitions(*at, "kind")
    return placed.mapInArrow(run, "query_id long, vec_id long, score long")


def reaching(packs: DataFrame, centers: dict[int, np.ndarray], shards: Shards) -> DataFrame:
    """(width, shard, tree): each pack for every shard but its own with a cell that may hold a score as high as its worst."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, own, tree in zip(batch.column("width").to_pylist(), batch.column("own").to_pylist(), batch.column("tree")):
                if width not in shards.radius:
                    continue
                pack, radius = pickle.loads(tree.as_py()), shards.radius[width]
                cells, worst = centers.get(width, np.zeros((1, width))), pack.carried.min()
                norms = np.sqrt((cells ** 2).sum(1))
                most = pack.centers[:1] @ cells.T + pack.radii[0] * norms + radius * pack.norms[0] + pack.radii[0] * radius
                use = np.flatnonzero(~hopeless(most[0], worst) & (radius >= 0))
                wanted = sorted({x for c in use for x in range(int(shards.first[width][c]), int(shards.last[width][c]) + 1)} - {own})
                for x in wanted:
                    yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([x], pa.int32()), pa.array([tree.as_py()], pa.binary())], ["width", "shard", "tree"])

    return packs.mapInArrow(run, "width int, shard int, tree binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query.

    The score is the inner product of floor(scale * x) over the components, as
    whole numbers below 2**53; ties go to the smaller vec_id. Candidates are all
    rows whose vec_id isn't the query's. Vectors that are null or hold null or
    non-finite components take no part; vectors of another length than the
    query's are no candidates; a vec_id repeated as a query counts once, repeated
    candidates as often as they come. Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    rows = whole_vectors(vectors, scale)
    centers = sample_centers(rows)
    indexed = materialize(in_cells(rows, centers))
    stats = indexed.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    cells, shards = in_shards(stats, centers)
    few = F.broadcast(cells)
    # the table's own row numbers deal out the rows of a repeated vec_id too
    block = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("n_blocks")).cast("int")
    numbered = indexed.select("width", "cell", "vec_id", "v").join(few, ["width", "cell"]).withColumn("block", block)
    blocks = trees(numbered, ["width", "cell", "block"], VECTORS, ["vec_id"]).join(few, ["width", "cell"])
    blocks = materialize(blocks.select("width", "cell", "block", shard_of("block").alias("shard"), "tree"))

    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialize(in_cells(asked, centers).drop("away"))
    salts = max(1, asked.count() // (QUERIES * 64))
    # similar queries, those of one cell, share packs
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))

    def packs(found: DataFrame | None) -> DataFrame:
        """(width, cell, salt, tree) of the queries, with the k-th scores found so far."""
        if found is None:
            rows = salted.withColumn("worst", F.lit(float("-inf")))
        else:
            known = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
            rows = salted.join(known.select(F.col("query_id").alias("vec_id"), "least"), "vec_id", "left").withColumn("worst", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf")))).drop("least")
        return trees(rows, ["width", "cell", "salt"], QUERIES, ["vec_id"], "worst")

    # one block of the own cell, then its shard, then all others
    first = materialize(visited(packs(None), blocks.where("block = 0"), k, ["width", "cell"]))
    own = packs(first).join(few, ["width", "cell"]).select("width", shard_of(F.lit(0)).alias("shard"), "cell", "salt", "tree")
    near = materialize(visited(own, blocks, k, ["width", "shard"]))
    sent = packs(near).join(few, ["width", "cell"]).select("width", shard_of(F.lit(0)).alias("own"), "cell", "salt", "tree")
    far = visited(reaching(sent, centers, shards), blocks, k, ["width", "shard"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = near.unionByName(far)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
