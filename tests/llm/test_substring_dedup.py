import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from forumlens.llm import common as C
from forumlens.llm.queries import QUERIES
from forumlens.llm.substring_dedup import _least, _seeds, substring_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    """The contract word by word: {(id, text): (words, removed, kept text)}."""
    split = [(k, t, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    seen = Counter(tuple(w[i:i + window]) for _, _, w in split
                   for i in range(len(w) - window + 1))
    out = []
    for k, _, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op1_substring_dedup"](spark, SF).collect()]
    want = [(k, n, g, hashlib.sha256(t.encode()).hexdigest()) for k, n, g, t in brute(rows, 35)]
    assert sorted(got, key=repr) == want
    assert any(g for _, _, g, _ in want) and any(not g for _, _, g, _ in want)


def test_edges(spark):
    rows = [(1, "a b c d e f"), (2, "x  a b\tc d\ny"), (2, "x  a b\tc d\ny"), (3, None), (4, ""),
            (None, "q r s q r s q r s"), (5, " \n\t "), (6, "é ü a b c"), (7, "z " * 300000),
            (8, "w" * 3_000_000 + " a b"), (9, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as block", "2 as n_words", "3 as ID")
    out = substring_dedup(df, window=3)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect()]
    assert sorted(got, key=repr) == brute(rows, 3)
    spans = {r.doc_id: [tuple(x) for x in r.removed] for r in out.collect()}
    assert spans[1] == [(0, 4)] and spans[9] == []


def test_empty(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_cut_at_slices(monkeypatch):
    monkeypatch.setattr(C, "_SLICE", 7)
    s, e, v = C.scan_words(b"aa bbbbbbbbbbbbbbbbbb aa  c aa", C.IS_SPACED)
    assert list(zip(s, e, strict=True)) == [(0, 2), (3, 21), (22, 24), (26, 27), (28, 30)]
    assert v[0] == v[2] == v[4] != v[3]
    assert list(C.rolling(v, 2)) == [C.rolling(v[i:i + 2], 2)[0] for i in range(4)]


@pytest.mark.parametrize("window", [1, 2, 5, 35])
def test_seeds_of_equal_windows(window):
    x = np.random.default_rng(3).integers(0, 4, 300).astype(np.uint64)
    x[200:260] = x[20:80]
    seeds = _seeds(x, window)
    assert len(seeds) == 300 - window + 1
    seen = {}
    for i, v in enumerate(seeds):
        assert seen.setdefault(tuple(x[i:i + window]), v) == v
    for n in (1, 2, 3, 7, 8, 300, 301):
        assert list(_least(x, n)) == [min(x[i:i + n]) for i in range(300 - n + 1)]


@pytest.mark.parametrize("window", [1, 2, 7, 35])
def test_windows_in_other_blocks(spark, window):
    """Each text in a block of its own, as far as hashing deals them."""
    word = np.random.default_rng(window).integers(0, 9, 4000)
    texts = [" ".join(map(str, word[i:i + 90])) for i in range(0, 4000, 45)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:3], "lone " * 20])]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), window=window)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=repr) == brute(rows, window)


def test_hashes_are_counted_by_spark(spark):
    plan = QUERIES["op1_substring_dedup"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [count(1)") == 2
