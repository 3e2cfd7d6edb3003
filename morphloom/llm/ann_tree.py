"""Approximate nearest neighbours by cosine in a hierarchical k-means tree.

The tree is fitted to a bounded sample and small enough to go to every task. All rows
are placed in its leaves. A query walks the tree best bin first: a priority queue holds
the nodes seen so far by the similarity of their centres, and the best one is opened,
until enough leaves are visited. How many are enough is calibrated: for some queries
the true neighbours are found among all rows, and the visits are widened until the
leaves visited hold the wanted share of them. Queries then meet the rows of their
leaves; a leaf with many rows or many queries is cut into blocks of each.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from morphloom.llm.common import keep

SAMPLE = 16_384  # rows the tree is fitted on
BRANCH = 16
LEAF = 64  # rows of the sample that are not split further
CALIBRATION = 100  # queries with known neighbours
RECALL = 0.97
BLOCK = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that are neither NULL nor zero and have finite components."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.where("vec_id is not null and v is not null").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # squares of large components stay finite
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _centres(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8):
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres, (x @ centres.T).argmax(axis=1)


class Tree:
    """``nodes``: for each inner node its centres and their children, a node's number or,
    for leaf l, -1 - l."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 1):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        x = unit(x)
        self.root = self._grow(x, branch, leaf, rng)

    def _grow(self, x, branch, leaf, rng) -> int:
        distinct = len(np.unique(x[: 4 * leaf], axis=0)) if len(x) > leaf else 1
        if len(x) > leaf and distinct > 1:
            # No more children than full leaves: the leaves grow with the sample, evenly.
            centres, own = _centres(x, min(branch, -(-len(x) // leaf)), rng)
            used = np.unique(own)
            if len(used) > 1:
                number = len(self.nodes)
                self.nodes.append((centres[used], []))
                for u in used:
                    self.nodes[number][1].append(self._grow(x[own == u], branch, leaf, rng))
                return number
        self.n_leaves += 1
        return -self.n_leaves

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: down to the nearest centre at every node."""
        x, at = unit(x), np.full(len(x), self.root, np.int64)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                here = np.flatnonzero(at == node)
                centres, children = self.nodes[node]
                at[here] = np.array(children)[(x[here] @ centres.T).argmax(axis=1)]
        return -1 - at

    def visits(self, v: np.ndarray):
        """Leaves in the order in which a query opens them."""
        v = unit(v[None, :])[0]
        queue = [(-np.inf, self.root)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -1 - node
                continue
            centres, children = self.nodes[node]
            for near, child in zip(centres @ v, children):
                heapq.heappush(queue, (-near, child))


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row."""
    a, b = q / np.abs(q).max(), v / np.abs(v).max(axis=1, keepdims=True)
    dots = np.einsum("ij,j->i", b, a)
    return dots / (np.sqrt(np.einsum("j,j->", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def nearest(q_ids, q, c_ids, c, k: int) -> tuple[np.ndarray, ...]:
    """(query, candidate, score, row of the candidate) of the ``k`` nearest ids in a block,
    ties by smaller id. An id goes by the nearest of its vectors.

    Of the ids of equal vectors only the k + 1 smallest can be among them.
    """
    rows = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[rows], np.ascontiguousarray(c[rows])
    _, same = np.unique(c.view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_inverse=True)
    by = np.lexsort((c_ids, same))
    new = np.diff(same[by], prepend=-1) != 0
    # an id with one vector twice counts once
    fresh = new | np.concatenate([[True], c_ids[by][1:] != c_ids[by][:-1]])
    order = np.cumsum(fresh)
    starts = np.flatnonzero(new)
    place = order - np.repeat(order[starts], np.diff(np.append(starts, len(by))))
    few = np.sort(by[fresh & (place <= k)])
    rows, c_ids, c = rows[few], c_ids[few], c[few]
    near = unit(q) @ unit(c).T
    near[q_ids[:, None] == c_ids[None, :]] = -np.inf
    starts = np.flatnonzero(np.concatenate([[True], c_ids[1:] != c_ids[:-1]]))
    of_id = np.maximum.reduceat(near, starts, axis=1)
    out = [], [], [], []
    for i, row in enumerate(near):
        n = min(k, len(starts))
        limit = np.partition(of_id[i], len(starts) - n)[len(starts) - n]
        cols = np.flatnonzero((row >= limit - 1e-9) & (row > -np.inf))
        score = exact(q[i], c[cols])
        best = np.lexsort((-score, c_ids[cols]))
        ids = c_ids[cols][best]
        best = best[np.concatenate([[True], ids[1:] != ids[:-1]])] if len(ids) else best
        best = best[np.lexsort((c_ids[cols[best]], -score[best]))][:k]
        out[0].append(np.full(len(best), q_ids[i]))
        out[1].append(c_ids[cols[best]])
        out[2].append(score[best])
        out[3].append(rows[cols[best]])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _batch(q, v, s, schema=_FOUND, *more):
    arrays = [pa.array(a, t) for a, t in zip((q, v, s, *more), schema.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def build(rows: DataFrame, sample: int = SAMPLE) -> Tree | None:
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    return Tree(np.array([r.v for r in chosen])) if chosen else None


def calibrate(placed: DataFrame, tree: Tree, k: int, recall: float, queries: int = CALIBRATION) -> int:
    """Leaves to visit for ``recall``, from the true neighbours of some of the rows."""
    chosen = placed.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(queries).select("vec_id", "v").collect()
    q_ids, q = np.array([r.vec_id for r in chosen]), np.array([r.v for r in chosen])
    schema = pa.schema([*_FOUND, ("leaf", pa.int32())])

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            if not len(ids):
                continue
            a, b, s, row = nearest(q_ids, q, ids, matrix(batch.column("v")), k)
            yield _batch(a, b, s, schema, batch.column("leaf").to_numpy()[row])

    true = placed.select("vec_id", "v", "leaf").mapInArrow(
        run, "query_id long, vec_id long, score double, leaf int"
    )
    best = F.max(F.struct("score", "leaf")).alias("best")
    true = true.groupBy("query_id", "vec_id").agg(best).select("query_id", "vec_id", "best.*")
    leaves: dict[int, list[int]] = {}
    for r in ranked(true, k).select("query_id", "leaf").collect():
        leaves.setdefault(r.query_id, []).append(r.leaf)
    needed = []
    for i, v in zip(q_ids, q):
        place = {leaf: n for n, leaf in enumerate(tree.visits(v), 1)}
        needed += [place[leaf] for leaf in leaves.get(i, [])]
    visits = 1
    while needed and np.mean(np.array(needed) <= visits) < recall:
        visits += 1
    return visits


def search(
    vectors: DataFrame, every: int = 50, k: int = 5, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """For each vector whose id is divisible by ``every``, the ``k`` nearest other ones:
    query_id, rank, vec_id, score (cosine in double precision).

    Ties go to the smaller id. Vectors that are NULL, zero, not finite, or of another
    length than most of a sample take no part, nor do rows without id. Rows with the
    same id count as one whose best vector decides. An empty table gives an empty result
    and other columns are ignored. ``sample`` bounds the rows that the tree is fitted on.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # An id with one vector twice is one row; what tasks read repeatedly is combined first.
    rows = rows.where(F.size("v") == lengths.d).distinct()
    tree = build(rows, sample)

    def place(batches):
        for batch in batches:
            leaf = tree.place(matrix(batch.column("v"))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"]
            )

    placed = keep(rows.mapInArrow(place, "vec_id long, v array<double>, leaf int"))
    held = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Each id in one of the leaves it is in, so that leaves hold as many ids as they say.
    ids = placed.groupBy("vec_id").agg(F.min("leaf").alias("leaf"))
    n_ids = {r.leaf: r.n for r in ids.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    visits = calibrate(placed, tree, k, recall)

    def walk(batches):
        for batch in batches:
            ids, leaves, picked = batch.column("vec_id").to_pylist(), [], []
            for i, v in enumerate(matrix(batch.column("v")) if ids else []):
                seen = 0
                for n, leaf in enumerate(tree.visits(v)):
                    if n >= visits and seen > k:
                        break
                    seen += n_ids.get(leaf, 0)
                    leaves.append(leaf)
                    picked.append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(picked, pa.int64())),
                    batch.column("v").take(pa.array(picked, pa.int64())),
                    pa.array(leaves, pa.int32()),
                ],
                names=["vec_id", "v", "leaf"],
            )

    asked = placed.where(F.col("vec_id") % every == 0).select("vec_id", "v")
    walked = keep(asked.mapInArrow(walk, "vec_id long, v array<double>, leaf int"))
    asking = {r.leaf: r.n for r in walked.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}

    # both tables hold at most one entry per leaf of the tree
    def blocks(counts):
        cut = {leaf: -(-n // BLOCK) for leaf, n in counts.items() if n > BLOCK}
        if not cut:
            return F.lit(1)
        table = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair])
        return F.coalesce(F.try_element_at(table, F.col("leaf")), F.lit(1))

    def dealt(df, own, other, names):
        mine = F.pmod(F.xxhash64("vec_id"), blocks(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), blocks(other) - 1))
        return df.select("vec_id", "v", "leaf", mine.alias(names[0]), theirs.alias(names[1]))

    left = dealt(walked, asking, held, ("qb", "cb"))
    right = dealt(placed, held, asking, ("cb", "qb"))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return pa.Table.from_batches([], schema=_FOUND)
        found = nearest(
            queries.column("vec_id").to_numpy(),
            matrix(queries.column("v")),
            candidates.column("vec_id").to_numpy(),
            matrix(candidates.column("v")),
            k,
        )
        return pa.Table.from_batches([_batch(*found[:3])])

    keys = ["leaf", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        meet, "query_id long, vec_id long, score double"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked(best, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
