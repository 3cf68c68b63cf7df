"""Each stage against the brute-force version of its operator, on what came before."""

import re

import test_decontaminate
import test_line_dedup
import test_simhash
from pyspark.sql import functions as F

import corpus_pipeline as P
from forumlens.llm import common as C
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark):
    docs = C.read(spark, SF, "documents")
    kept = C.stored(P.quality(spark, docs, SF), "t")
    assert kept.schema.names == docs.schema.names
    good = {r.doc_id for r in QUERIES["op2_quality"](spark, SF).where("accepted").collect()}
    assert texts(kept) == texts(docs.where(F.col("doc_id").isin(list(good))))
    before, rows = kept, texts(kept)

    kept = C.stored(P.lines(spark, before, SF), "t")
    want = test_line_dedup.brute(rows, 1)
    emptied = {k for k, n, g, _, t in want if g and t == ""}
    assert texts(kept) == sorted(((k, t) for k, _, _, _, t in want if k not in emptied), key=repr)
    assert kept.where("n_chars <> length(text)").count() == before.where("n_chars <> length(text)").count()
    rows = texts(kept)

    kept = C.stored(P.near(spark, kept, SF), "t")
    one = {c for _, _, c in test_simhash.brute(rows)}
    assert texts(kept) == [r for r in rows if r[0] in one]
    rows = texts(kept)

    kept = C.stored(P.benchmark(spark, kept, SF), "t")
    items = [tuple(r) for r in C.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    hit = {k for k, _, h, _ in test_decontaminate.brute(rows, items, 10) if h}
    now = dict(texts(kept))
    assert {k for k, t in rows if now[k] != t} == hit and len(now) == len(rows)

    mixed = P.mix(spark, kept, SF)
    size = {r.doc_id: r for r in mixed.collect()}
    assert all(size[k].size == len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in now.items())
    done = P.run(spark, SF)
    assert sorted(done.collect()) == sorted(mixed.collect())
    assert done.columns == [*docs.columns, "size", "source_size", "target", "taken"]


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y z", "a"), (3, "x y z", "a"), (None, "some text here", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 as rating", "2 as mix", "3 as line_runs", "4 as contamination", "5 as taken", "6 as version")
    for docs in (df, df.limit(0)):
        for name, stage in P.STAGES:
            out = C.stored(stage(spark, docs, SF), "t")
            if name != "mix":
                assert out.columns == df.columns
            docs = out
    assert docs.count() == 0
