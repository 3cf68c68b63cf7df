"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on a bounded sample, down to leaves of a few vectors, and
every vector is dealt to a leaf.  A query goes down best bin first: a node promises
the inner product of query and centroid plus ``OPTIMISM`` times the spread of its
vectors, and no more than its parent.  A priority queue holds the inner nodes; the
best is opened, until enough leaves of opened nodes promise as much as any node
in the queue.  How many leaves a query visits is calibrated: brute force answers a
bounded set of queries over all vectors, and visits widen until the wanted recall
is reached.

Neighbouring leaves make up a cell; a leaf of more than a cell's vectors is cut
into cells by a hash of the id, so a vector that a third of the rows share fills
many cells, not one task.  A query goes once to each cell with a leaf that it
visits, with a bit for each leaf.  The cell scores it against its leaves, exactly,
and answers with each query's best ``k``; where there are more than ``QUERIES``,
they too are dealt by a hash of the id, and each block of them meets a copy of
the cell.  The cell of a query's first leaf answers before the others, which then
answer only with what is among the best ``k`` so far.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from forumlens.llm import common as C

MAX_SAMPLE = 65_536
LEAF = 3  # sampled vectors per leaf, about
CELL = (2048, 32_768)  # vectors per cell: a task's share, within these bounds
QUERIES = 32_768  # queries that meet a cell at a time, on average
BRANCH = 128
OPTIMISM = 3.0
CALIBRATION = 96
TARGET = 0.97


@dataclass
class Tree:
    """Nodes by number; a leaf has no children and a leaf number."""

    centroids: list[np.ndarray] = field(default_factory=list)  # of each node's children
    spread: list[np.ndarray] = field(default_factory=list)  # of each node's children, per dimension
    children: list[np.ndarray] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row, going down to the nearest centroid."""
        out = np.zeros(len(x), np.int32)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not len(self.children[node]):
                out[rows] = self.leaf[node]
                continue
            near = _nearest(x[rows], self.centroids[node])
            for k, child in enumerate(self.children[node]):
                mine = rows[near == k]
                if len(mine):
                    stack.append((child, mine))
        return out

    def best_first(self, q: np.ndarray, visits: int) -> np.ndarray:
        """The first ``visits`` leaves of a best-bin-first traversal, in order."""
        numbers = np.array(self.leaf)
        if not len(self.children[0]):
            return numbers[:visits]
        queue, at_hand, promised = [(-np.inf, 0)], [], np.zeros(0)
        while queue:
            least, node = heapq.heappop(queue)
            if len(promised) >= visits and np.count_nonzero(promised >= -least) >= visits:
                break
            promise = np.minimum(self.centroids[node] @ q + OPTIMISM * self.spread[node], -least)
            number = numbers[self.children[node]]
            is_leaf = number >= 0
            promised = np.concatenate([promised, promise[is_leaf]])
            at_hand.append(number[is_leaf])
            for i in np.flatnonzero(~is_leaf).tolist():
                heapq.heappush(queue, (-promise[i].item(), int(self.children[node][i])))
        return np.concatenate(at_hand)[np.argsort(-promised, kind="stable")[:visits]]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(axis=1)[None, :] - 2 * (x @ centers.T), axis=1)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centers = np.unique(x[rng.choice(len(x), min(len(x), 4 * k), replace=False)], axis=0)
    centers = centers[rng.permutation(len(centers))[:k]]
    for _ in range(rounds):
        near = _nearest(x, centers)
        size = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        centers = (total / np.maximum(size, 1)[:, None])[size > 0]
    return centers


def fit_tree(sample: np.ndarray, leaves: int, seed: int = 5) -> Tree:
    """Split nodes until a leaf has its share of the sample, or up to three times that."""
    tree, rng = Tree(), np.random.default_rng(seed)
    share = max(1, len(sample) // max(1, leaves))

    def grow(rows: np.ndarray) -> int:
        node = len(tree.children)
        tree.centroids.append(np.zeros((0, sample.shape[1])))
        tree.spread.append(np.zeros(0))
        tree.children.append(np.zeros(0, np.int64))
        tree.leaf.append(-1)
        parts = []
        if len(rows) > 3 * share:
            centers = _k_means(sample[rows], min(BRANCH, -(-len(rows) // share)), rng)
            near = _nearest(sample[rows], centers)
            parts = [(c, rows[near == k]) for k, c in enumerate(centers) if (near == k).any()]
        if len(parts) < 2:  # small enough, or all alike
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            return node
        tree.centroids[node] = np.array([c for c, _ in parts])
        tree.spread[node] = np.array([np.sqrt(np.mean((sample[part] - c) ** 2)) for c, part in parts])
        tree.children[node] = np.array([grow(part) for _, part in parts])
        return node

    grow(np.arange(len(sample)))
    return tree


def cells_of(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each leaf its first cell and its number of cells, and for each cell
    its first leaf: runs of leaves of ``most`` vectors at most, or parts of one
    larger leaf."""
    first, count, low = [], [], []
    room = 0
    for leaf, n in enumerate(sizes.tolist()):
        if n > room or not low:
            parts = max(1, -(-n // most))
            first.append(len(low))
            low += [leaf] * parts
            room = most - n if parts == 1 else 0
        else:
            parts = 1
            first.append(len(low) - 1)
            room -= n
        count.append(parts)
    return np.array(first), np.array(count), np.array(low)


def _matrix(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.array(rows, np.float64) if rows else np.zeros((0, 0))


def _by_leaf(q: np.ndarray, x: np.ndarray, starts: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Inner products of queries with the rows of the leaves that they visit, else -inf."""
    out = np.full((len(q), len(x)), -np.inf)
    for leaf in np.flatnonzero((np.diff(starts) > 0) & seen.any(axis=0)):
        a, b, rows = starts[leaf], starts[leaf + 1], np.flatnonzero(seen[:, leaf])
        out[rows, a:b] = q[rows] @ x[a:b].T
    return out


def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
         starts: np.ndarray | None = None, seen: np.ndarray | None = None, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's ``k`` largest inner products, ties to
    the smaller id; rows of the query's own id don't count.  ``starts`` cuts the
    rows into leaves, ``seen`` tells which of them each query visits (without
    them: all); scores below a query's ``floor`` don't count.

    A matrix product finds who can be among them; these are scored one by one
    in a fixed order of summation, so equal vectors have equal scores.
    """
    out: tuple[list, list, list] = ([], [], [])
    floor = np.full(len(q), -np.inf) if floor is None else floor
    for a in range(0, len(q), 256):
        part = q[a:a + 256]
        rough = part @ x.T if seen is None else _by_leaf(part, x, starts, seen[a:a + 256])
        for query, vector, low, row in zip(query_ids[a:a + 256], part, floor[a:a + 256], rough, strict=True):
            row[ids == query] = -np.inf
            row[row < low - 1e-9 * (1 + abs(low))] = -np.inf
            n = min(k, int((row > -np.inf).sum()))
            if not n:
                continue
            least = np.partition(row, len(row) - n)[len(row) - n]
            some = np.flatnonzero(row >= least - 1e-9 * (1 + abs(least)))
            some = some[row[some] > -np.inf]
            score = (x[some] * vector).sum(axis=1)
            some, score = some[score >= low], score[score >= low]
            by = np.lexsort((ids[some], -score))[:n]
            out[0].append(np.full(len(by), query))
            out[1].append(ids[some[by]])
            out[2].append(score[by])
    join = [np.concatenate([*x, np.zeros(0, t)]).astype(t) for x, t in zip(out, (np.int64, np.int64, float), strict=True)]
    return join[0], join[1], join[2]


def _found(got) -> pa.Table:
    return pa.table({"query_id": got[0], "vec_id": got[1], "score": got[2]})


def _pack(kind: str):
    def run(batches):
        for batch in batches:
            rows = batch.column("vec")
            flat = rows.flatten().to_numpy(zero_copy_only=False).astype(kind)
            size = len(flat) // max(1, len(rows))
            packed = [flat[i * size:(i + 1) * size].tobytes() for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], ["id", "vec"])
    return run


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(id, vec as bytes) of the rows that take part, and the numbers' type.

    Those with an id and a vector of the most frequent length (of several, the
    smallest) without null, NaN or infinite entries, and not all zero.
    """
    vec, kind = F.col("vec"), "<f4" if isinstance(rows.schema[vec_col].dataType.elementType, FloatType) else "<f8"
    whole = rows.select(rows[id_col].cast("long").alias("id"), rows[vec_col].alias("vec")).where(
        F.col("id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
        & ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists(vec, lambda v: v != 0))
    size = whole.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return whole.select("id", F.lit(None).cast("binary").alias("vec")), kind
    return whole.where(F.size(vec) == size["n"]).mapInArrow(_pack(kind), "id long, vec binary"), kind


def _brute(ids: np.ndarray, q: np.ndarray, k: int, kind: str):
    """The best over a partition, so that what travels is k rows per query and task."""
    def run(batches):
        held = None
        for batch in batches:
            got = best(batch.column("id").to_numpy(), _matrix(batch.column("vec"), kind), ids, q, k)
            held = got if held is None else tuple(np.concatenate(p) for p in zip(held, got, strict=True))
            by = np.lexsort((held[1], -held[2], held[0]))
            query = held[0][by]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            held = tuple(p[by[rank < k]] for p in held)
        if held is not None:
            yield from _found(held).to_batches()
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


FOUND = "query_id long, vec_id long, score double"


def brute_force(rows: DataFrame, ids: np.ndarray, q: np.ndarray, k: int, kind: str) -> DataFrame:
    return _top(rows.mapInArrow(_brute(ids, q, k, kind), FOUND), k)


def calibrate(rows: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float, kind: str) -> int:
    """Leaf visits at which the bounded set of queries reaches the recall ``target``."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).toArrow()
    ids, q = some.column("id").to_numpy(), _matrix(some.column("vec"), kind)
    if not len(ids):
        return 1
    true = brute_force(rows, ids, q, k, kind).select("query_id", F.col("vec_id").alias("id")).distinct()
    at = true.join(F.broadcast(true.select("id").distinct()), "id").join(rows, "id")  # k * CALIBRATION ids at most
    got = at.select("query_id", "vec").toArrow()
    leaf = tree.assign(_matrix(got.column("vec"), kind))
    order = {i: np.argsort(tree.best_first(v, tree.leaves)) for i, v in zip(ids.tolist(), q, strict=True)}
    need = np.array([order[i][n] for i, n in zip(got.column("query_id").to_pylist(), leaf.tolist(), strict=True)])
    visits = 1
    while visits < tree.leaves and (need < visits).mean() < target:
        visits += 1
    return visits


def _deal(tree: Tree, kind: str):
    def run(batches):
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column("vec"), kind)) if batch.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["id", "vec", "leaf"])
    return run


def _send(tree: Tree, visits: int, first: np.ndarray, count: np.ndarray, low: np.ndarray, kind: str):
    high = np.append(low[1:], tree.leaves)
    high = np.maximum(high, low + 1)

    def run(batches):
        for batch in batches:
            to, row, bits, home = [], [], [], []
            for i, q in enumerate(_matrix(batch.column("vec"), kind)):
                seen, leaves = np.zeros(tree.leaves, bool), tree.best_first(q, visits)
                seen[leaves] = True
                cells = np.unique(np.concatenate([first[leaves], *(np.arange(first[k], first[k] + count[k])
                                                                   for k in leaves[count[leaves] > 1])]))
                to.append(cells)
                home.append(cells == first[leaves[0]])
                row += [i] * len(cells)
                bits += [np.packbits(seen[low[c]:high[c]]).tobytes() for c in cells]
            mine = batch.take(pa.array(row, pa.int64()))
            cell = np.concatenate([*to, np.zeros(0, np.int64)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*mine.columns, pa.array(bits, pa.binary()), pa.array(cell), pa.array(np.concatenate([*home, np.zeros(0, bool)]))],
                ["id", "vec", "seen", "cell", "home"])
    return run


def _search(k: int, kind: str, low: np.ndarray):
    def run(cell: pa.Table, queries: pa.Table) -> pa.Table:
        if not cell.num_rows or not queries.num_rows:
            return _found((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        cell = cell.sort_by("leaf")
        leaf = cell.column("leaf").to_numpy() - low[queries.column("cell")[0].as_py()]
        rows = [np.unpackbits(np.frombuffer(x, np.uint8)) for x in queries.column("seen").to_pylist()]
        seen = np.array(rows)[:, :leaf[-1] + 1].astype(bool)
        starts = np.searchsorted(leaf, np.arange(leaf[-1] + 2))
        return _found(best(cell.column("id").to_numpy(), _matrix(cell.column("vec"), kind),
                           queries.column("id").to_numpy(), _matrix(queries.column("vec"), kind), k, starts, seen,
                           queries.column("floor").to_numpy()))
    return run


def index_of(parts: DataFrame, queries: DataFrame, n: int, k: int, target: float, kind: str) -> tuple[Tree, int] | None:
    """The tree, and the leaves that a query visits; None without vectors."""
    sample = parts.where(F.pmod(F.xxhash64("id", F.lit("tree")), F.lit(1_000_000)) < 1e6 * MAX_SAMPLE / max(n, 1))
    sample = _matrix(sample.select("vec").toArrow().column("vec"), kind)
    if not len(sample):
        return None
    tree = fit_tree(sample, max(1, len(sample) // LEAF))
    return tree, calibrate(parts, queries, tree, k, target, kind) if tree.leaves > 1 else 1


def scored_share(tree: Tree, visits: int, x: np.ndarray, q: np.ndarray) -> float:
    """The share of the vectors ``x`` that a query of ``q`` is scored against, on average."""
    size = np.bincount(tree.assign(x), minlength=tree.leaves)
    return float(np.mean([size[tree.best_first(v, visits)].sum() for v in q]) / len(x))


def nearest(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product in double
    precision) of the ``k`` best found for each query: the rows whose id is
    divisible by ``every``, against all rows of other ids.

    Who takes part: see ``vectors``; others are neither queries nor answers.  Of
    several rows with a query's id the smallest bytes are searched; as
    candidates each row counts.  Fewer candidates than ``k`` are all returned.
    """
    parts, kind = vectors(rows, id_col, vec_col)
    parts = C.stored(parts, "vectors")
    asks = F.col("id") % every == 0
    n, n_queries = parts.agg(F.count(F.lit(1)), F.approx_count_distinct(F.when(asks, F.col("id")))).first()
    queries = parts.where(asks).groupBy("id").agg(F.min("vec").alias("vec"))
    index = index_of(parts, queries, n, k, target, kind)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree, visits = index
    dealt = C.stored(parts.mapInArrow(_deal(tree, kind), "id long, vec binary, leaf int"), "leaves")
    sizes = {r.leaf: r["count"] for r in dealt.groupBy("leaf").count().collect()}  # as many rows as leaves
    most = min(max(CELL[0], n // (2 * C.shuffle_width(rows.sparkSession))), CELL[1])
    first, count, low = cells_of(np.array([sizes.get(i, 0) for i in range(tree.leaves)]), most)
    table = rows.sparkSession.createDataFrame(
        [(i, int(f), int(c)) for i, (f, c) in enumerate(zip(first, count, strict=True))], "leaf int, first int, cells int")
    cell = F.col("first") + F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")
    dealt = dealt.join(F.broadcast(table), "leaf")  # as many rows as leaves
    width = C.shuffle_width(rows.sparkSession)
    sent = C.stored(queries.repartition(width).mapInArrow(
        _send(tree, visits, first, count, low, kind), "id long, vec binary, seen binary, cell int, home boolean"), "sent")
    blocks = max(1, -(-n_queries // QUERIES))
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
    vectors_ = dealt.select("id", "vec", "leaf", cell.alias("cell"), copies.alias("block"))

    def answers(asked: DataFrame) -> DataFrame:
        asked = asked.select("id", "vec", "seen", "floor", "cell", block.alias("block"))
        return (vectors_.groupBy("cell", "block").cogroup(asked.groupBy("cell", "block"))
                .applyInArrow(_search(k, kind, low), FOUND))

    nothing = F.lit(float("-inf"))
    near = C.stored(_top(answers(sent.where("home").withColumn("floor", nothing)), k), "near")
    floor = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = sent.where("not home").join(floor, "id", "left").withColumn("floor", F.coalesce("floor", nothing))
    found = near.drop("rank").unionByName(answers(rest))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
