import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import ann
from forumlens.llm.queries import QUERIES


def brute(rows, every=20, k=20):
    """{query: [(id, score)]} over all rows, in exact sums of doubles."""
    out = {}
    for q, v in rows:
        if q % every == 0:
            got = [(-math.fsum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q]
            out[q] = [(i, -s) for s, i in sorted(got)[:k]]
    return out


def test_query_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    x = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    m, ids = np.array(x.embedding.tolist(), np.float64), x.vec_id.to_numpy()
    got = {}
    for r in QUERIES["op7_nearest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]].tolist()
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(sc - s[ids == i][0]) < 1e-12 for _, i, sc in mine)
        assert [(-sc, i) for _, i, sc in mine] == sorted((-sc, i) for _, i, sc in mine)
        hits += len(set(want) & {i for _, i, _ in mine})
        total += 20
    assert hits / total >= 0.9


def test_calibrated_recall(spark):
    """What the calibration aims at, within a hundredth, over all queries."""
    x = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids, m = x.toPandas().vec_id.to_numpy(), np.array(x.toPandas().embedding.tolist(), np.float64)
    got = {(r.query_id, r.vec_id) for r in ann.nearest(x).collect()}
    queries = np.flatnonzero(ids % 20 == 0)
    score = m[queries] @ m.T
    score[np.arange(len(queries)), queries] = -np.inf
    want = {(ids[q], i) for q, s in zip(queries, score, strict=True) for i in ids[np.lexsort((ids, -s))[:20]]}
    assert len(want & got) / len(want) >= 0.96


@pytest.mark.parametrize("clusters", [1, 30])
def test_tree_search(spark, monkeypatch, clusters):
    monkeypatch.setattr(ann, "CELL", (64, 64))
    rng = np.random.default_rng(clusters)
    x = (rng.normal(size=(clusters, 8))[rng.integers(0, clusters, 1500)] + 0.4 * rng.normal(size=(1500, 8))).round(3)
    x[400:900] = x[400]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows)
    assert got.keys() == want.keys()
    near = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert near >= 0.9 * 20 * len(want)
    assert all(len(got[q]) == 20 for q in want)


def test_blocks_of_queries(spark, monkeypatch):
    """No cell meets more queries than a block, and the answers are the same."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 6)).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(tuple(r) for r in ann.nearest(df, every=2).collect())
    search = ann._search

    def bounded(k, kind, low):
        run = search(k, kind, low)

        def checked(cell, queries):
            assert queries.num_rows <= 90
            return run(cell, queries)
        return checked

    monkeypatch.setattr(ann, "_search", bounded)
    monkeypatch.setattr(ann, "QUERIES", 40, raising=False)
    assert sorted(tuple(r) for r in ann.nearest(df, every=2).collect()) == want
    assert len(want) == 750 * 20


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []),
            (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
            (40, [0.0, 0.0]), (60, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as id", "3 as leaf")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (0, 4, 20, 0.5),
                   (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.5)]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("embedding is null")).count() == 0


def _index(spark, x, every=20, k=20):
    """Tree, visits, vectors and queries as ``nearest`` has them."""
    parts, kind = ann.vectors(x, "vec_id", "embedding")
    queries = parts.where(f"id % {every} = 0").groupBy("id").agg(F.min("vec").alias("vec"))
    n = parts.count()
    tree, visits = ann.index_of(parts, queries, n, k, ann.TARGET, kind)
    m, q = (ann._matrix(t.toArrow().column("vec"), kind) for t in (parts, queries))
    return tree, visits, m, q


def test_share_of_vectors_scored(spark):
    """Under half on these vectors of hardly any structure, and less where there are more."""
    small = _index(spark, spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    large = _index(spark, spark.read.parquet("/root/testdata/check_s/embeddings.parquet"))
    share = [ann.scored_share(t, v, m, q[:100]) for t, v, m, q in (small, large)]
    assert share[1] < share[0] < 0.5, share


def test_clustered_vectors(spark):
    """Structure is used: few vectors are scored, and the recall holds over all queries."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, 4000)] + 0.25 * rng.normal(size=(4000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    tree, visits, m, q = _index(spark, df)
    assert ann.scored_share(tree, visits, m, q) < 0.2
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df).collect()}
    score = x[::20] @ x.T
    score[np.arange(200), np.arange(200) * 20] = -np.inf
    want = {(20 * i, j) for i, s in enumerate(score) for j in np.argsort(-s)[:20].tolist()}
    assert len(want & got) / len(want) >= 0.96


def test_cells_hold_runs_of_leaves():
    first, count, low = ann.cells_of(np.array([3, 4, 0, 25, 2, 2, 9, 1]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 5, 5] and count.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]
    assert low.tolist() == [0, 3, 3, 3, 4, 6]


def leaf_by_leaf(tree, q, n):
    """One node at a time from a priority queue, leaves too."""
    queue, found = [(-np.inf, 0)], []
    while queue and len(found) < n:
        least, node = heapq.heappop(queue)
        if not len(tree.children[node]):
            found.append(tree.leaf[node])
            continue
        for c, s, child in zip(tree.centroids[node], tree.spread[node], tree.children[node].tolist(), strict=True):
            heapq.heappush(queue, (max(least, -(c @ q + ann.OPTIMISM * s)), child))
    return found


def test_traversal_reaches_all_leaves():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    tree = ann.fit_tree(x, 100)
    assert tree.leaves > 20
    for q in x[:5]:
        assert sorted(tree.best_first(q, tree.leaves)) == list(range(tree.leaves))
        for n in (1, 3, tree.leaves // 2):
            assert tree.best_first(q, n).tolist() == tree.best_first(q, tree.leaves)[:n].tolist() == leaf_by_leaf(tree, q, n)
    assert set(tree.assign(x).tolist()) <= set(range(tree.leaves))
    assert ann.fit_tree(np.ones((50, 3)), 10).leaves == 1
