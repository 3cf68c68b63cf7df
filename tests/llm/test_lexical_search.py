import math
import re

import numpy as np
import oracle
import pytest

from forumlens.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """The score's definition in whole numbers, over all pairs."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in sorted(set(items), key=repr):
        scored = []
        for i, t in held:
            m = 100 - 25 + (25 * len(t) * n_docs) // n_terms
            s = 0
            for x in terms(text):
                if x in t:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    s += w * ((10**9 * t.count(x)) // (1000 * t.count(x) + 12 * m))
            if s:
                scored.append((-s, 2**63 - 1 if i is None else i))
        out += [(item, r + 1, None if i == 2**63 - 1 else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k=20):
    got = L.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_against_sql(spark):
    oracle.compare(spark, "op12_ranked_search", "/root/testdata/sf0.01")


@pytest.mark.parametrize("blocks", [False, True])
def test_against_brute_force(spark, monkeypatch, blocks):
    """Also with many shards, blocks of items and no vocabulary in the tasks."""
    monkeypatch.setattr(L, "DOC_LEAF", 4)
    monkeypatch.setattr(L, "ITEM_LEAF", 2)
    if blocks:
        monkeypatch.setattr(L, "SHARD_DOCS", 7)
        monkeypatch.setattr(L, "BLOCK_TERMS", 40)
        monkeypatch.setattr(L, "VOCABULARY", 5)
        monkeypatch.setattr(L, "FIRST", 4)
    rng = np.random.default_rng(5)
    words = ["a", "B", "c1", "ÉCOLE", "école", "x-y", "der", "Z_z", "long" * 20, "日本"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 30)))) for i in rng.permutation(150)]
    docs += [(200 + i, docs[3][1]) for i in range(40)]  # ties
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 8)))) for i in range(23)]
    assert found(spark, docs, items, 5) == brute(docs, items, 5)


def test_edges(spark):
    docs = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, "..."), (None, "alpha beta"), (5, "gamma " * 5000)]
    items = [(1, "alpha"), (1, "alpha"), (1, "Gamma gamma"), (None, "beta"), (2, None), (3, "unknown"), (4, "")]
    assert found(spark, docs, items, 2) == brute(docs, items, 2)
    assert found(spark, docs, items) == brute(docs, items, 20)
    assert found(spark, [], items) == [] == found(spark, docs, []) == found(spark, [(1, None)], items)
    df = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, n int, item int")
    assert L.ranked_search(df, df.selectExpr("1 as item_id", "text", "2 as id", "3 as term")).count() == 1
    more = spark.createDataFrame([(1, "a b", 3, 4), (2, "c", 5, 6)], "doc_id long, text string, n int, item int")
    assert L.ranked_search(more, df.selectExpr("1 as item_id", "text", "2 as id", "3 as term")).count() == 1


def test_bounds_leave_out_whole_batches():
    """On clustered points most pairs are never scored, and the result is that of all pairs."""
    rng = np.random.default_rng(1)
    size, n, asks = 400, 2000, 64

    def points(count):
        rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * int(c) for c in rng.integers(0, 20, count)]
        return L.Points(np.full(count, 8), np.concatenate(rows), rng.integers(1, 1000, 8 * count), size)

    docs, items = points(n), points(asks)
    search = L.Search(docs, np.arange(n), items, np.zeros(asks, np.int64), 10)
    search.run()
    score = items.dense(np.arange(asks)) @ docs.dense(np.arange(n)).T
    for i in range(asks):
        best = sorted((-s, d) for d, s in enumerate(score[i].tolist()) if s > 0)[:10]
        assert [(-s, d) for s, d in zip(*map(np.ndarray.tolist, search.found[i]), strict=True)] == best
    assert search.scored < 0.1 * n * asks
    tree = search.doc_tree
    assert len(tree.first) > 32 and sorted(tree.order.tolist()) == list(range(n))


def test_scores_beyond_doubles_stay_exact():
    docs = L.Points(np.array([2, 1]), np.array([0, 1, 0]), np.array([1_000_000, 999_999, 999_999]), 2)
    items = L.Points(np.array([2]), np.array([0, 1]), np.array([3 * 10**10, 10**10 + 1]), 2)
    search = L.Search(docs, np.array([7, 8]), items, np.zeros(1, np.int64), 5)
    assert search.exact is np.int64
    search.run()
    assert search.found[0][0].tolist() == [3 * 10**16 + 999_999 * (10**10 + 1), 999_999 * 3 * 10**10]
