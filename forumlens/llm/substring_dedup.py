"""Substring deduplication by Rabin-Karp window hashes, counted in Spark.

Documents are dealt to blocks, and a block gives the distinct hashes of its
windows of ``window`` words as rows.  Spark counts the blocks of each hash: a
hash has one row per block however often it occurs there, so a hot passage
cannot swell a task.  The rows that other blocks share go back, and the block
merges its repeated windows into maximal word intervals.

Most windows are told unique before they travel.  A window's seed is the least
hash among the runs of half its words in it; neighbouring windows mostly share
theirs.  Equal windows have equal seeds, so a window whose seed no other block
has stands in no other block.  Seeds are counted first, in the same way, and
only windows with a shared seed are then counted themselves.

Blocks follow ``spark.sql.shuffle.partitions``.  Hashes have 64 bits: among n
windows about n**2 / 2**65 pairs collide by chance (2 in 8 billion windows);
colliding seeds change no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C

BLOCKS_PER_PARTITION = 2
SENT = "hash long, block int"


def _hashes(texts: list[bytes | None], window: int) -> list[tuple]:
    """Per group of texts: (first, end, offsets, words' starts and ends, first
    word of each text, words' values, window hashes, whether a window stays in
    its text)."""
    for a, b, data, at in C.doc_groups(texts):
        s, e, v = C.scan_words(data, C.IS_SPACED)
        first = np.searchsorted(s, at)
        last = np.repeat(first[1:], np.diff(first))
        h = C.rolling(v, window)
        inside = last[:len(h)] - np.arange(len(h)) >= window
        yield a, b, data, s, e, first, v, h, inside


def _distinct(texts: list[bytes | None], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct window hashes, and which occur twice or more."""
    parts = [h[ok] for *_, h, ok in _hashes(texts, window)]
    every = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    at = np.flatnonzero(new)
    return every[at], np.diff(np.append(at, len(every))) > 1


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` consecutive values."""
    if len(x) < n:
        return x[:0]
    span = 1
    while 2 * span <= n:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = n - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _seeds(values: np.ndarray, window: int) -> np.ndarray:
    """The seed of every window of word values."""
    half = max(1, window // 2)
    return _least(C.rolling(values, half), window - half + 1)


def _among(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` stand in the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


def _rows(block: pa.Table, parts: list[np.ndarray]) -> pa.Table:
    keys = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    at = block.column("block")[0].as_py() if len(block) else 0
    return pa.table({"hash": pa.array(keys.view(np.int64)), "block": pa.array(np.full(len(keys), at, np.int32))})


def _told(answers: pa.Table) -> np.ndarray:
    return np.sort(answers.column("hash").to_numpy().view(np.uint64))


def _send_seeds(window: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        found = _hashes(block.column("text").to_pylist(), window)
        return _rows(block, [_seeds(v, window)[ok] for *_, v, _, ok in found])
    return run


def _send_windows(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Hashes of the windows whose seeds other blocks have."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        seeds, parts = _told(answers), []
        if len(seeds):
            for *_, v, h, ok in _hashes(block.column("text").to_pylist(), window):
                parts.append(h[ok & _among(seeds, _seeds(v, window))])
        return _rows(block, parts)
    return run


def _shared(sent: DataFrame) -> DataFrame:
    """The rows whose hash another block sent too; a hash has at most one row per block."""
    n = F.count(F.lit(1)).over(Window.partitionBy("hash"))
    return sent.withColumn("n", n).where("n > 1").select("hash", "block")


def _merge(window: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        texts = block.column("text").to_pylist()
        keys, repeated = _distinct(texts, window)
        keys = np.union1d(keys[repeated], _told(answers))
        words, gone, kept, spans = [], [], [], []
        for a, b, data, s, e, first, _, h, inside in _hashes(texts, window):
            cover = np.zeros(len(s) + 1, np.int32)
            start = np.flatnonzero(_among(keys, h) & inside)
            cover[start] += 1
            cover[start + window] -= 1
            out = np.cumsum(cover[:-1]) > 0
            token = data.split()
            for k in range(b - a):
                i, j = first[k], first[k + 1]
                cut = out[i:j]
                n = int(cut.sum())
                words.append(int(j - i))
                gone.append(n)
                mine = token[i:j]
                if n:
                    edge = np.zeros(len(cut) + 2, np.int8)
                    edge[1:-1] = cut
                    turn = np.flatnonzero(np.diff(edge))
                    spans.append([{"start": int(x), "end": int(y)}
                                  for x, y in zip(turn[0::2], turn[1::2], strict=True)])
                    mine = [mine[x] for x in np.flatnonzero(~cut)]
                else:
                    spans.append([])
                kept.append(b" ".join(mine))
        return pa.table({
            "id": block.column("id"), "n_words": pa.array(words, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()),
                                                           ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        })
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 35) -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_words, n_removed, removed (maximal
    intervals of word numbers, end exclusive) and kept_text (the words left,
    joined by single spaces).

    A word goes if a window of ``window`` words that covers it also starts
    anywhere else, in any row or its own.  Null and empty texts have no words
    and keep the empty text; rows with the same id are separate documents; ids
    may be null; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    n = C.shuffle_width(spark) * BLOCKS_PER_PARTITION
    kind = docs.schema[id_col].dataType.simpleString()
    key, text = docs[id_col], docs[text_col]
    rows = docs.select(
        F.pmod(F.xxhash64(key, text), F.lit(n)).cast("int").alias("block"),
        key.alias("id"), text.cast("binary").alias("text"))
    blocks = rows.groupBy("block")
    seeds = _shared(blocks.applyInArrow(_send_seeds(window), SENT))
    windows = _shared(blocks.cogroup(seeds.groupBy("block")).applyInArrow(_send_windows(window), SENT))
    out = blocks.cogroup(windows.groupBy("block")).applyInArrow(
        _merge(window), f"id {kind}, n_words long, n_removed long, "
                        "removed array<struct<start:long,end:long>>, kept_text string")
    return out.withColumnRenamed("id", id_col)
