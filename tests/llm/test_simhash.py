import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from forumlens.llm import simhash
from forumlens.llm.bk_tree import Classes, Tree, classes, link
from forumlens.llm.components import components
from forumlens.llm.queries import QUERIES
from forumlens.llm.simhash import keep_one, near_duplicates

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def print_of(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + k]).encode(), 42).intdigest() for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(prints, radius):
    """Plain search over all pairs: the position of the least print reached."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def brute(rows, radius=4):
    prints = sorted({print_of(t) for _, t in rows})
    root = dict(zip(prints, reach(prints, radius), strict=True))
    least = {}
    for k, t in rows:
        r = root[print_of(t)]
        least[r] = min(x for x in (least.get(r), k) if x is not None) if k is not None or r in least else None
    return sorted(((k, f"{print_of(t):016x}", least[root[print_of(t)]]) for k, t in rows), key=repr)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op6_simhash"](spark, SF).collect()]
    want = brute(rows)
    assert sorted(got, key=repr) == want
    assert any(k != c for k, _, c in want)


def test_native_hash_is_the_same(spark):
    got = spark.createDataFrame([("a b c d",), ("é",)], "t string").select(F.hex(F.xxhash64("t"))).collect()
    assert [int(r[0], 16) for r in got] == [xxhash.xxh64(x.encode(), 42).intdigest() for x in ("a b c d", "é")]


@pytest.mark.parametrize("seed", range(6))
def test_tree_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = [x ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 7))))
             for x in base for _ in range(rng.integers(1, 20))]
    prints = np.unique(np.array(flips, np.uint64))
    for radius in (0, 2, 4):
        assert classes(prints, radius).tolist() == reach([int(x) for x in prints], radius)


def test_trees_of_the_corpus_do_the_work(spark):
    """The shards of sf0.1 are trees of over a thousand nodes, and leave out distances."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    prints = {r.print for r in simhash.fingerprints(rows, "doc_id", "text", 4).collect()}
    prints = np.unique(np.array(sorted(prints), np.int64).view(np.uint64))
    masks = simhash.shard_masks(len(prints), 4, simhash.SHARD)
    assert len(masks) == 5
    nodes = taken = every = 0
    for mask in masks:
        for value in np.unique(prints & np.uint64(mask)):
            shard = prints[prints & np.uint64(mask) == value]
            tree = Tree(shard)
            assert len(shard) > 1000 and len(np.concatenate(tree.levels)) == len(shard) and len(tree.levels) > 4
            taken += link(tree, shard, 4, Classes(len(shard)), 0)
            nodes, every = nodes + len(shard), every + len(shard) ** 2
    assert nodes == 5 * len(prints) and taken < 0.8 * every, taken / every


def test_edges_within_the_radius_only():
    """Every node hangs by its distance to its parent, and no query takes a distance beyond the radius."""
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 63, 700, dtype=np.uint64))
    tree = Tree(prints)
    for p in range(len(prints)):
        kids = tree.children[tree.start[p, 0]:tree.start[p, -1]]
        far = np.bitwise_count(prints[kids] ^ prints[p])
        assert (tree.parent[kids] == p).all() and len(set(far.tolist())) == len(kids) and (np.diff(far.astype(int)) > 0).all()
    assert sorted(np.concatenate(tree.levels).tolist()) == list(range(len(prints)))
    few, many = (link(tree, prints, r, Classes(len(prints)), 0) for r in (0, 8))
    assert few < 0.1 * len(prints) ** 2 < many
    assert link(Tree(prints[:0]), prints, 4, Classes(700), 0) == 0


@pytest.mark.parametrize("n", [10, 10**5, 10**7, 10**9, 10**12])
def test_masks_miss_no_link(n):
    rng = np.random.default_rng(n % 97)
    for radius in (0, 2, 4, 7):
        masks = np.array(simhash.shard_masks(n, radius, 4096), np.uint64)
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert (masks & np.uint64(flips) == 0).any()


def test_large_shards_are_cut_into_blocks(spark, monkeypatch):
    """The classes are the same, and no task gets more than two blocks of a shard."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(120)]
    rows += [(200 + i, " ".join(["same"] * 40 + list(rng.choice(words, 2)))) for i in range(80)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "MOST", 16)
    monkeypatch.setattr(simhash, "SHARD", 64)
    stars = simhash._stars

    def bounded(radius):
        run = stars(radius)

        def checked(group):
            assert group.num_rows <= 64
            return run(group)
        return checked

    monkeypatch.setattr(simhash, "_stars", bounded)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect()]
    assert sorted(got, key=repr) == want


def test_edges(spark):
    rows = [(5, None), (4, ""), (4, ""), (None, " "), (9, "One two"), (8, "one  TWO"), (8, "other text here"),
            (7, "a b c d e f g"), (6, "word " * 200000), (3, "word " * 100000), (2, "x" * 2_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as version", "2 as print", "3 as component_id")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect()]
    assert sorted(got, key=repr) == brute(rows)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert len(kept.collect()) == len({f for _, f, _ in brute(rows)})
    assert keep_one(df.limit(0)).count() == 0


def test_null_ids_only(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "zz yy")], "doc_id long, text string")
    assert sorted(r.text for r in keep_one(df).collect()) == ["a", "zz yy"]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
