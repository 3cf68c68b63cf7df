import gzip
import io
import json
import os
from urllib.parse import urlparse

import pytest
from oracle import compare

from forumlens.llm import common as C
from forumlens.llm import warc as W

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    names, rows = compare(spark, "op5_warc", f"/root/testdata/{sf}")
    assert rows


PAGES = [(1, "http://a/", "<p>é</p>"), (2, None, None), (3, "http://b/ x\r\ny", ""), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"),
         (None, "v", "only here"), (None, "v", "<p>é</p>"), (5, "w", "two\r\n\r\nends\r\n\r\n"), (6, "x", "WARC/1.1\r\n\r\n"),
         (7, "y", "long " * 300_000), (8, "z", "\n")]


def test_round_trip_and_files(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "1 as digest", "2 as bytes", "3 as first")
    raw, folder = C.new_folder(spark, "t-raw"), C.new_folder(spark, "t")
    W.write_archives(pages, raw)
    index = W.normalise(spark, raw, folder)
    got = W.read_archives(index, folder).collect()
    assert len(got) == len(PAGES)
    full = {r.payload_digest: r.payload for r in got if r.record_type == "response"}
    assert sorted((int(r.id) if r.id else None, full[r.payload_digest]) for r in got if r.id) == sorted(
        (k, h or "") for k, _, h in PAGES if k)
    kind = sorted((r.id or "", r.record_type, r.refers_to) for r in got)
    assert kind.count(("4", "response", None)) == 2 and ("1", "revisit", "4") in kind and ("2", "revisit", "3") in kind
    assert ("", "response", None) in kind and ("", "revisit", "4") in kind
    assert all(r.payload_bytes == len(full[r.payload_digest].encode()) for r in got)
    # every index row is a gzip member of its own, and the sidecars say the same
    base = urlparse(folder).path
    told = [json.loads(x) for f in os.listdir(base) if f.endswith(".index") for x in open(f"{base}/{f}")]
    assert sorted(map(str, told)) == sorted(str(r.asDict()) for r in index.collect())
    for r in told:
        with open(f"{base}/{r['archive']}", "rb") as f:
            f.seek(r["offset"])
            assert gzip.decompress(f.read(r["length"])).startswith(b"WARC/1.1\r\n")
    assert not [f for f in os.listdir(base) if f.startswith("_")]


def test_least_bytes_and_empty(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    got = W.through_archives(pages, least_bytes=5).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 5)
    assert any(r.record_type == "revisit" for r in got)
    assert W.through_archives(pages.limit(0)).count() == 0


def test_streams():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\n\r\n\r\n"
    many = gzip.compress(record * 3) + gzip.compress(record)
    for read, size in ((1, 1), (7, 3), (1000, 1000), (1000, 5)):
        parts = list(W.inflated(W.pieces(io.BytesIO(many), read), size))
        assert max(map(len, parts)) <= size and list(W.split_records(iter(parts))) == [record] * 4
    for bad in (many[:-3], many[:30], gzip.compress(record)[:-9] ):
        with pytest.raises(ValueError):
            list(W.split_records(W.inflated(W.pieces(io.BytesIO(bad)))))
    assert list(W.inflated(iter([]))) == []
    assert list(W.split_records(iter([record[i:i + 1] for i in range(len(record))]))) == [record]
    with pytest.raises(ValueError):
        list(W.split_records(iter([record[:-2]])))


def test_archives_beyond_the_size_that_spark_reads_whole(spark):
    """A monolithic archive over the limit of whole files: only Spark's list of it is needed."""
    raw, folder = C.new_folder(spark, "t-raw"), C.new_folder(spark, "t")
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 2000) for i in range(300)], SCHEMA).coalesce(1)
    W.write_archives(pages, raw)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        with pytest.raises(Exception, match="max"):
            spark.read.format("binaryFile").load(raw).select("content").collect()
        index = W.normalise(spark, raw, folder)
        assert index.count() == 300 and index.select("archive").distinct().count() == 1
        assert {int(r.id): len(r.payload) for r in W.read_archives(index, folder).collect()} == {
            i: len(f"page {i} ") * 2000 for i in range(300)}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
