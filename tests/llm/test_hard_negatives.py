import math

import numpy as np
import oracle
import pytest

from forumlens.llm import hard_negatives as H


def brute(rows, every=100, positives=5, negatives=10):
    """The definition over all pairs, in whole numbers."""
    good = [(i, str(y), [math.floor(256 * x) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, y, v in good:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (y, v)), (y, v))
    out = []
    for a, (label, va) in anchors.items():
        near = sorted((-sum(p * q for p, q in zip(va, v, strict=True)), i, y) for i, y, v in good if i != a and len(v) == len(va))
        for s, p, _ in [x for x in near if x[2] == label][:positives]:
            fits = [(n, i) for n, i, y in near if y != label and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fits)]
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return sorted(tuple(r) for r in H.mine_hard_negatives(df, **more).collect())


def test_query_against_sql(spark):
    oracle.compare(spark, "op13_hard_negatives", "/root/testdata/sf0.1")


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    """Also in many cells, with blocks of anchors and of rows that are scored."""
    if small:
        monkeypatch.setattr(H, "CANDIDATES", (32, 32))
        monkeypatch.setattr(H, "ANCHORS", 8)
        monkeypatch.setattr(H, "ROWS", 16)
        monkeypatch.setattr(H, "SIDE", 3)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 11)) * 0.3
    x[100:220] = x[100]  # a very common vector
    y = np.where(rng.random(400) < 0.4, 1, rng.integers(0, 40, 400))  # a hot label, and rare ones
    rows = [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(y, x, strict=True))]
    assert found(spark, rows, every=10) == brute(rows, every=10)


@pytest.mark.parametrize("low, high, size", [(-3, 3, 8), (0, 0, 5), (-150, 140, 64), (-2**25, 2**25, 17), (5, 6, 1), (-2, -1, 9)])
def test_tables_give_inner_products(low, high, size):
    rng = np.random.default_rng(size)
    a, c = rng.integers(low, high + 1, (7, size)), rng.integers(low, high + 1, (50, size))
    codes = H.pack(c)
    assert codes.shape[1] == H.n_planes(c.min(), c.max())
    assert (H.scores(H.subset_sums(a, np.int64), codes.transpose(1, 2, 0)) == c @ a.T).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 1.0]), (2, 1, [1.0, 1.0]), (3, 2, [0.5, 0.5]), (3, 2, [0.5, 0.5]),
            (4, 2, [0.5, 0.5]), (5, 2, [-1.0, 0.0]), (6, None, [0.5, 0.5]), (7, 2, None), (8, 2, [nan, 0.5]),
            (9, 2, [inf, 0.5]), (10, 2, [None, 0.5]), (None, 2, [0.5, 0.5]), (11, 2, [0.5, 0.5, 0.5]), (100, 3, [1.0, 1.0]),
            (200, 1, [-1.0, -1.0]), (300, 4, []), (12, 4, []), (13, 5, []), (0, 2, [9.0, 9.0]), (14, 2, [0.33333, 0.7])]
    got = found(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got if r[:2] == (0, 1)] == [3, 3, 4, 14]
    assert (300, 12, 1, 13, 0, 0) in got  # empty vectors score 0
    assert found(spark, []) == [] == found(spark, [(1, 1, [0.5])]) == found(spark, [(0, 1, [0.5]), (1, 2, [0.5])])
    big = [(0, 1, [1e300, 1.0]), (100, 1, [2.0**17, 1.0]), (1, 1, [2.0**17, 1.0]), (2, 2, [2.0**16, 3.0]), (3, 2, [1e6, 1.0])]
    assert found(spark, big) == brute([r for r in big if r[2][0] < 2**18])
    df = spark.createDataFrame([(r[0], r[1], r[2], 1, 2) for r in rows],
                               "vec_id long, label int, embedding array<float>, side int, planes int")
    assert H.mine_hard_negatives(df).count() == len(got)
