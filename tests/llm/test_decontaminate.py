import hashlib
import re

import numpy as np
import pytest

from forumlens.llm import common as C
from forumlens.llm import decontaminate as decontamination
from forumlens.llm.decontaminate import decontaminate
from forumlens.llm.fm_index import FMIndex, suffix_array
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
FOLD = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(FOLD))


def brute(docs, items, width):
    windows = {}
    for key, t in items:
        w = words(t)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(key)
    sizes = {len(w) for w in windows}
    for key, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[x]
        yield key, len(w), len(hit), sorted(str(x) for x in ids if x is not None)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = sorted((k, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
                  for k, n, h, i in brute(docs, items, 10))
    assert sorted(tuple(r) for r in QUERIES["op3_decontaminate"](spark, SF).collect()) == want
    assert any(x[-1] for x in want) and not all(x[-1] for x in want)


@pytest.mark.parametrize("block_bytes", [1 << 20, 8])
def test_edges(spark, block_bytes):
    docs = [(1, "x A b-C d, e y"), (2, None), (3, ""), (3, ""), (None, "a b c a b c d"), (4, "é a"),
            (5, "a b"), (6, "c d e"), (7, "solo"), (8, "a b c " * 100000), (9, "?!")]
    items = [(1, "a b c d e"), (1, "a b c d e"), (2, "Solo"), (3, None), (4, ""), (None, "É a"), (5, "é A"), (10, "b c a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "7 as n_words", "8 as _found2")
    out = decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), width=3,
                        block_bytes=block_bytes).collect()
    got = [(r.doc_id, r.contamination.n_words, sum(s.end - s.start for s in r.contamination.spans),
            r.contamination.items) for r in out]
    assert sorted(got, key=repr) == sorted(brute(docs, items, 3), key=repr)
    text = {r.doc_id: r.contamination.clean_text for r in out}
    assert text[1] == "x  y" and text[2] is None and text[3] == "" and text[7] == "" and text[5] == "a b"
    assert out[0].n_words == 7


def test_blocks_are_bounded_by_their_windows(spark, monkeypatch):
    """One pass never holds much more than a block of windows, whatever the text."""
    words_of = [f"{chr(97 + k % 26)}{k}" for k in range(600)]
    items = spark.createDataFrame([(1, " ".join(words_of)), (2, " ".join(words_of[300:]))], "item_id long, text string")
    docs = [(k, " ".join(words_of[k:k + 12])) for k in range(0, 590, 7)]
    held, find, stored, kept = [], decontamination._find, C.stored, []
    monkeypatch.setattr(decontamination, "_find", lambda ph: held.append(len(ph.windows)) or find(ph))
    monkeypatch.setattr(C, "stored", lambda df, name: kept.append(df.columns) or stored(df, name))
    out = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), items, block_bytes=16_384).collect()
    got = [(r.doc_id, r.contamination.n_words, sum(s.end - s.start for s in r.contamination.spans),
            r.contamination.items) for r in out]
    rows = [tuple(r) for r in items.collect()]
    assert sorted(got) == sorted(brute(docs, rows, 10))
    assert sum(held) == 591 and len(held) > 1 and max(held) <= 2 * 16_384 // 80
    assert not any("text" in c or "doc_id" in c for c in kept)  # between the passes no text is written


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate(docs, none).collect()[0].contamination.spans == []
    assert decontaminate(docs.limit(0), none).count() == 0


def test_index_against_scan():
    rng = np.random.default_rng(1)
    for symbols in (3, 5, 40):
        text = np.append(rng.integers(1, symbols, 900), 0)
        text[100:300] = text[500:700]
        assert suffix_array(text, 6).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = FMIndex(text, symbols)
        for size in (1, 2, 5):
            at = rng.integers(0, 800, 30)
            pats = np.stack([text[a:a + size] for a in at])
            lo, hi = index.search(pats, np.full(30, size))
            for p, a, b in zip(pats, lo, hi, strict=True):
                want = [i for i in range(len(text)) if text[i:i + size].tolist() == p.tolist()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_odd_and_clashing_columns(spark):
    items = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d y", 5, {"k.`": 1})], "`id.x` long, text string, `con tam`` ` int, m map<string,int>")
    docs = docs.withColumn("Contamination", docs["text"])
    for block_bytes in (1 << 20, 8):
        out = decontaminate(docs, items, width=3, block_bytes=block_bytes)
        assert out.columns == [*docs.columns, "contamination_"]
        row = out.first()
        assert row["contamination_"].clean_text == "x  y" and row["contamination_"]["items"] == ["1", "2"] and row["m"] == {"k.`": 1}
