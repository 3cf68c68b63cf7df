"""Benchmark decontamination: an FM-index over every training shard.

A shard is a run of documents of about 2 MB (or one longer document) inside a
task, so the corpus isn't shuffled.  Its words become symbols: one for each
benchmark word, one for all others (runs of those shrink to one).  Every
distinct benchmark window is searched backwards, its occurrences are located by
sampled suffix positions, and the covered words merge into removal spans.

Tasks cut the benchmark into its distinct windows, a table in the shared folder.
It travels in blocks of at most ``BLOCK_BYTES`` of windows and ids on average.
With one block a single pass finds and cuts.  More blocks are a reading pass each,
which leaves spans and items of the hit texts only; their texts are cut once, at
the end.  Words are told apart by 64-bit values: n distinct ones give about
n^2 / 2^65 chance collisions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm import common as C
from forumlens.llm.fm_index import FMIndex

BLOCK_BYTES = 32 << 20
BATCH = 65_536  # windows of an item that a task holds at a time
SPAN = "array<struct<start:long,end:long>>"


@dataclass
class Phrases:
    """Distinct windows of one benchmark block, over symbols 2.. of its words."""

    vocabulary: np.ndarray  # sorted 64-bit word values
    windows: np.ndarray  # right-aligned symbols
    lengths: np.ndarray
    items: list[list[str]]  # ids of the items that have each window


def _windows(width: int):
    """(window, id) for every window of an item: the 64-bit values of its words."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for key, text in zip(batch.column("id"), texts, strict=True):
                v = C.scan_words(text.as_py() or b"", C.IS_ALNUM, C.FOLD)[2].astype("<u8")
                n = max(1, len(v) - width + 1) if len(v) else 0
                for a in range(0, n, BATCH):
                    found = [v[i:i + width].tobytes() for i in range(a, min(a + BATCH, n))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array([key.as_py()] * len(found), pa.string())],
                        ["window", "id"])
    return run


def window_table(items: DataFrame, width: int) -> DataFrame:
    """(window, items, size): the distinct windows of ``items`` (id, text), the ids
    of the items that have each, and the bytes of both."""
    found = items.mapInArrow(_windows(width), "window binary, id string").groupBy("window").agg(
        F.collect_set("id").alias("items"))
    size = F.aggregate("items", F.octet_length("window").cast("long"), lambda n, x: n + F.octet_length(x))
    return found.withColumn("size", size)


def phrases(table: pa.Table | None, width: int) -> Phrases:
    rows = [] if table is None else table.column("window").to_pylist()
    lengths = np.array([len(w) // 8 for w in rows], np.int64)
    vocabulary, symbols = np.unique(np.frombuffer(b"".join(rows), "<u8"), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), lengths)
    at = np.arange(len(symbols)) - (np.cumsum(lengths) - width)[row]
    windows = np.zeros((len(rows), width), np.int64)
    windows[row, at] = symbols + 2
    return Phrases(vocabulary, windows, lengths, [] if table is None else table.column("items").to_pylist())


def shard_hits(values: np.ndarray, first: np.ndarray, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences in one shard as (number of the first word, number of the window).

    ``values``: the shard's word values; ``first``: first word of each document,
    and the end.
    """
    none = np.zeros(0, np.int64)
    if not len(ph.vocabulary) or not len(values):
        return none, none
    at = np.minimum(np.searchsorted(ph.vocabulary, values), len(ph.vocabulary) - 1)
    symbols = np.where(ph.vocabulary[at] == values, at + 2, 1)
    # a break (1) before each document, so that no window spans two of them
    word = np.insert(np.arange(len(values)), first[:-1], -1)
    text = np.insert(symbols, first[:-1], 1)
    keep = text != 1
    keep[1:] |= text[:-1] != 1  # runs of foreign words shrink to one
    text, word = text[keep], word[keep]
    if not (text > 1).any():
        return none, none
    index = FMIndex(np.append(text, 0), len(ph.vocabulary) + 2)
    lo, hi = index.search(ph.windows, ph.lengths)
    found = np.flatnonzero(hi > lo)
    sizes = hi[found] - lo[found]
    which = np.repeat(found, sizes)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[which]
    return word[index.locate(rows)], which


def _intervals(cover: np.ndarray) -> list[dict]:
    edge = np.zeros(len(cover) + 2, np.int8)
    edge[1:-1] = cover
    turn = np.flatnonzero(np.diff(edge)).tolist()
    return [{"start": a, "end": b} for a, b in zip(turn[0::2], turn[1::2], strict=True)]


FOUND = pa.struct([("n_words", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                   ("items", pa.list_(pa.string())), ("clean_text", pa.string())])


def _texts(texts: list[bytes | None], ph: Phrases):
    """For each text: its words' first and last bytes, which words are hit, and
    the items whose windows hit them."""
    for a, b, data, at in C.doc_groups(texts):
        s, e, v = C.scan_words(data, C.IS_ALNUM, C.FOLD)
        first = np.searchsorted(s, at)
        start, which = shard_hits(v, first, ph)
        cover = np.zeros(len(s) + 1, np.int32)
        np.add.at(cover, start, 1)
        np.subtract.at(cover, start + ph.lengths[which], 1)
        hit = np.cumsum(cover[:-1]) > 0
        doc = np.searchsorted(first, start, side="right") - 1
        ids: dict[int, set[str]] = {}
        for k, w in np.unique(np.stack([doc, which]), axis=1).T.tolist():
            ids.setdefault(k, set()).update(ph.items[w])
        for k in range(b - a):
            i, j = first[k], first[k + 1]
            yield s[i:j] - at[k], e[i:j] - at[k], hit[i:j], ids.get(k, set())


def _result(text: bytes | None, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray, items: set[str]) -> dict:
    spans = _intervals(hit) if hit.any() else []
    if spans:  # from a span's first to its last byte
        cuts = [(starts[x["start"]], ends[x["end"] - 1]) for x in spans]
        edges = [0, *(int(y) for c in cuts for y in c), len(text)]
        text = b"".join(text[x:y] for x, y in zip(edges[0::2], edges[1::2], strict=True))
    return {"n_words": len(hit), "spans": spans, "items": sorted(items),
            "clean_text": None if text is None else text.decode()}


def _scan(ph: Phrases, text_at: int):
    """Finds and cuts, with all windows at hand."""
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            found = [_result(t, *x) for t, x in zip(texts, _texts(texts, ph), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, FOUND)], [*batch.schema.names, "made"])
    return run


def _find(ph: Phrases):
    """(key, spans, items) of the hit texts among (key, text), with one block of windows."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [{"key": key, "spans": _intervals(hit), "items": sorted(items)}
                     for key, (_, _, hit, items) in zip(batch.column("key").to_pylist(), _texts(texts, ph), strict=True)
                     if hit.any()]
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                ("key", pa.binary()), ("spans", FOUND.field("spans").type), ("items", FOUND.field("items").type)]))
    return run


def _cut(text_at: int, spans_at: int, items_at: int):
    """Cuts what the blocks' passes found."""
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            found = []
            for text, (s, e, hit, _), spans, items in zip(
                    texts, _texts(texts, phrases(None, 1)), batch.column(spans_at).to_pylist(),
                    batch.column(items_at).to_pylist(), strict=True):
                hit = hit.copy()
                for x in spans or ():
                    hit[x["start"]:x["end"]] = True
                found.append(_result(text, s, e, hit, set(items or ())))
            columns = [c for k, c in enumerate(batch.columns) if k not in (spans_at, items_at)]
            names = [n for k, n in enumerate(batch.schema.names) if k not in (spans_at, items_at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, FOUND)], [*names, "made"])
    return run


def _in_blocks(docs: DataFrame, text_col: str, table: DataFrame, numbers: list[int], width: int) -> DataFrame:
    """(key, spans, items) of the hit texts; the key is the text's MD5."""
    texts = docs.select(F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("key"), F.col(text_col).alias("text"))
    found = None
    for number in numbers:
        ph = phrases(table.where(F.col("block") == number).select("window", "items").toArrow(), width)
        one = C.stored(texts.where("text is not null").mapInArrow(
            _find(ph), f"key binary, spans {SPAN}, items array<string>"), "found")
        found = one if found is None else found.unionByName(one)
    return found.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
                                    F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 10,
                  result: str = "contamination", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, spans (maximal
    intervals of hit word numbers, end exclusive), items (ids as strings,
    sorted, of the items with an occurring window) and clean_text (the text
    without what lies from a span's first to its last character).

    A window is ``width`` consecutive words of an item; a shorter item is one
    window.  Words are runs of letters, digits and all beyond ASCII, A-Z
    lower-cased.  Null and empty texts have no words and stay as they are; an
    item without an id cleans but isn't listed; repeated rows count alike; an
    empty benchmark hits nothing.  If ``docs`` has a column ``result`` the new one
    gets underscores.
    """
    result = C.free_name(docs, result)
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
    table = C.stored(window_table(items, width), "benchmark")
    blocks = max(1, -(-(table.agg(F.sum("size")).first()[0] or 0) // block_bytes))
    at = docs.columns.index(text_col)
    kind = T.StructType.fromDDL(f"n_words long, spans {SPAN}, items array<string>, clean_text string")
    if blocks == 1:
        ph = phrases(table.select("window", "items").toArrow(), width)
        return C.add_in_arrow(docs, _scan(ph, at), result, kind)
    table, path = table.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks))), C.new_folder(
        docs.sparkSession, "benchmark-blocks")
    table.repartition("block").write.partitionBy("block").parquet(path)
    table = docs.sparkSession.read.schema(table.schema).parquet(path)
    numbers = sorted(r.block for r in table.select("block").distinct().collect())  # as many rows as passes
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    found = C.stored(_in_blocks(plain, f"c{at}", table, numbers, width), "hits")
    keyed = plain.withColumn("key", F.unhex(F.md5(F.col(f"c{at}").cast("binary"))))
    found = found.repartition(C.shuffle_width(docs.sparkSession))  # so that Spark may split a text that many rows share
    hits = keyed.join(found, "key", "left").select(*plain.columns, "spans", "items")
    n = len(plain.columns)
    schema = T.StructType([*plain.schema.fields, T.StructField("made", kind)])
    return hits.mapInArrow(_cut(at, n, n + 1), schema).toDF(*docs.columns, result)
