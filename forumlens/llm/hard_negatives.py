"""Hard negatives by Four-Russians scoring.

Components become integers.  A candidate is packed into bit planes: one byte
holds one bit of eight components.  For an anchor all 256 subset sums of each
group of eight components are computed once; a candidate's bytes index them,
and the sums, shifted by their plane and added, are the exact inner product.

Anchors and candidates meet in cells of bounded size, a block of the ones and
a block of the others, so no task holds more than its cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C

#: Least and most candidates of a cell; in between a share of the table for each task.
CANDIDATES = (4_096, 131_072)
#: Anchors of a cell.
ANCHORS = 16_384
#: Components of this size or more have scores that a long may not hold.
LARGEST = 1 << 26
#: Rows and anchors that are scored at a time.
ROWS, SIDE = 8_192, 16

_NONE = np.iinfo(np.int64).min


def n_planes(least: int, most: int) -> int:
    """Bits of the two's complement that holds both."""
    return 1 + max(int(most).bit_length(), int(~least if least < 0 else 0).bit_length())


def pack(values: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of (rows, components) integers: bit j of byte
    g in plane p is bit p of component 8 g + j."""
    planes = n_planes(values.min(initial=0), values.max(initial=0))
    return np.stack([np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
                     for p in range(planes)], axis=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): sums of each subset of eight components."""
    n, size = anchors.shape
    groups = -(-size // 8)
    whole = np.zeros((n, groups * 8), kind)
    whole[:, :size] = anchors
    whole = whole.reshape(n, groups, 8).transpose(1, 2, 0)
    sums = np.zeros((groups, 256, n), kind)
    for j in range(8):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + whole[:, j, None]
    return sums


def scores(sums: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products; codes: (planes, groups, rows) bytes, the
    highest plane counts negative."""
    planes, groups, rows = codes.shape
    total = np.zeros((rows, sums.shape[2]), sums.dtype)
    for p in range(planes - 1, -1, -1):
        plane = np.zeros_like(total)
        for g in range(groups):
            plane += sums[g].take(codes[p, g], axis=0)
        total = -plane if p == planes - 1 else (total << 1) + plane
    return total


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of each anchor's ``k`` highest scores, ties by id; ``_NONE`` doesn't count."""
    if len(score) > k:
        least = np.partition(score, len(score) - k, axis=0)[len(score) - k]
        row, col = np.nonzero((score >= least) & (score > _NONE))
    else:
        row, col = np.nonzero(score > _NONE)
    by = np.lexsort((ids[row], -score[row, col], col))
    row, col = row[by], col[by]
    keep = np.arange(len(col)) - np.searchsorted(col, col) < k
    return row[keep], col[keep]


def _planes(column: pa.Array, size: int) -> np.ndarray:
    """(rows, planes, groups) bytes; rows with fewer planes repeat their sign."""
    groups = -(-size // 8)
    data = column.to_pylist()
    if not groups:
        return np.zeros((len(data), 1, 0), np.uint8)
    width = np.array([len(x) // groups for x in data])
    out = np.zeros((len(data), width.max(initial=1), groups), np.uint8)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at, :w] = np.frombuffer(b"".join(data[i] for i in at), np.uint8).reshape(len(at), w, groups)
        out[at, w:] = out[at, w - 1:w]
    return out


def _pairs(cell: pa.Table, anchors: pa.Table, same: bool):
    """Blocks of the cell's pairs with equal labels, or unequal ones, and vectors of one length:
    (score matrix, candidate ids, anchor rows).  Pairs that don't count hold ``_NONE``."""
    labels = pc.unique(pa.chunked_array([*cell.column("label").chunks, *anchors.column("label").chunks], pa.string()))
    row_label, anchor_label = (pc.index_in(t.column("label"), labels).to_numpy() for t in (cell, anchors))
    row_size, anchor_size = (t.column("size").to_numpy() for t in (cell, anchors))
    row_id, anchor_id = (t.column("id").to_numpy() for t in (cell, anchors))
    for size in np.intersect1d(row_size, anchor_size):
        at = np.flatnonzero(row_size == size)
        at = at[np.argsort(row_label[at], kind="stable")]
        asks = np.flatnonzero(anchor_size == size)
        codes = _planes(cell.column("planes").take(pa.array(at)).combine_chunks(), size)
        whole = np.frombuffer(b"".join(anchors.column("whole").take(pa.array(asks)).to_pylist()),
                              np.int32).reshape(len(asks), size).astype(np.int64)
        most = int(np.abs(whole).max(initial=0)) << codes.shape[1]
        kind = np.int32 if most * max(int(size), 1) < 1 << 31 else np.int64
        for a in range(0, len(at), ROWS):
            rows = at[a:a + ROWS]
            low, high = row_label[rows[0]], row_label[rows[-1]]
            meets = (anchor_label[asks] >= low) & (anchor_label[asks] <= high)
            if not same:
                meets = ~meets | (low != high)
            part = np.ascontiguousarray(codes[a:a + ROWS].transpose(1, 2, 0))
            mine = np.flatnonzero(meets)
            for b in range(0, len(mine), SIDE):
                ask = mine[b:b + SIDE]
                score = scores(subset_sums(whole[ask], kind), part).astype(np.int64)
                wrong = (row_label[rows][:, None] == anchor_label[asks[ask]]) != same
                score[wrong | (row_id[rows][:, None] == anchor_id[asks[ask]])] = _NONE
                yield score, row_id[rows], asks[ask]


class _Best:
    """The best of several blocks: each block's best, cut again in the end."""

    def __init__(self, k: int):
        self.k, self.parts = k, []

    def add(self, key: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((key, ids, score))

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = (np.zeros(0, np.int64),) * 3
        key, ids, score = (np.concatenate(x) for x in zip(*[none, *self.parts], strict=True))
        by = np.lexsort((ids, -score, key))
        by = by[np.arange(len(by)) - np.searchsorted(key[by], key[by]) < self.k]
        return key[by], ids[by], score[by]


def _positives(k: int):
    def run(cell: pa.Table, anchors: pa.Table) -> pa.Table:
        found = _Best(k)
        if cell.num_rows and anchors.num_rows:
            for score, ids, ask in _pairs(cell, anchors, same=True):
                row, col = best(score, ids, k)
                found.add(ask[col], ids[row], score[row, col])
        key, ids, score = found.result()
        return pa.table({"anchor_id": anchors.column("id").to_numpy()[key] if len(key) else key, "id": ids,
                         "score": score})
    return run


def _negatives(k: int, low: int, high: int):
    def run(cell: pa.Table, anchors: pa.Table) -> pa.Table:
        found, wants = _Best(k), anchors.column("wants").to_pylist() if anchors.num_rows else []
        most = max(map(len, wants), default=0)
        given = np.array([[w[p]["score"] if p < len(w) else -1 for p in range(most)] for w in wants],
                         np.int64).reshape(len(wants), most)
        if cell.num_rows and most:
            for score, ids, ask in _pairs(cell, anchors, same=False):
                for p in range(most):  # a negative positive score leaves no score between its shares
                    want = given[ask, p]
                    least, limit = -(-low * want // 100), high * want // 100
                    fits = np.where((score >= least) & (score <= limit) & (want >= 0), score, _NONE)
                    row, col = best(fits, ids, k)
                    found.add(ask[col] * most + p, ids[row], score[row, col])
        key, ids, score = found.result()
        asked = [wants[i // most][i % most] for i in key.tolist()]
        return pa.table({
            "anchor_id": pa.array(anchors.column("id").to_numpy()[key // most] if len(key) else key, pa.int64()),
            "nth": pa.array([x["nth"] for x in asked], pa.int32()),
            "positive_id": pa.array([x["id"] for x in asked], pa.int64()), "id": ids,
            "positive_score": pa.array([x["score"] for x in asked], pa.int64()), "score": score})
    return run


def _packed(every: int, scale: float):
    """Rows with their planes, and of the anchors the integers."""
    def run(batches):
        for batch in batches:
            vec, ids = batch.column("vec"), batch.column("id").to_numpy()
            size = pc.list_value_length(vec).to_numpy(zero_copy_only=False).astype(np.int32)
            flat = np.floor(vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            start = np.cumsum(size) - size
            fits, planes, whole = np.zeros(len(size), bool), [None] * len(size), [None] * len(size)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                values = flat[start[at, None] + np.arange(n)]
                fine = (np.abs(values) < LARGEST).all(axis=1)
                at, values = at[fine], values[fine].astype(np.int64)
                fits[at] = True
                for i, codes, v in zip(at.tolist(), pack(values), values, strict=True):
                    planes[i] = codes.tobytes()
                    if ids[i] % every == 0:
                        whole[i] = v.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(size), pa.array(planes, pa.binary()),
                 pa.array(whole, pa.binary())], ["id", "label", "size", "planes", "whole"]).filter(pa.array(fits))
    return run


def mine_hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30,
                        high: int = 90, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
                        label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score, all of them exact inner products of floor(scale * component).

    Anchors are the rows whose id is divisible by ``every``; an anchor's
    positives are the ``positives`` best other rows of its label, and for each of
    them the ``negatives`` best rows of other labels with ``low`` to ``high`` per
    cent of the positive's score are returned.  Equal scores are ordered by id.

    Rows without id, label or vector, or with a null, NaN or infinite component,
    take no part, nor do those with integers of 2**26 or more (up to 2,047
    components every score fits a long).  Vectors of unequal length don't meet; empty ones
    score 0.  Rows that share an id all count as candidates, but not for an
    anchor of that id; of several rows the anchor is the smallest by label, then
    by length and bytes.  Anchors without positives, and positives without
    negatives, give no rows; an empty table gives none.
    """
    spark, vec = rows.sparkSession, F.col("vec")
    whole = rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].cast("string").alias("label"),
                        rows[vec_col].cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull()
        & ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    whole = C.stored(whole.mapInArrow(_packed(every, scale),
                                      "id long, label string, size int, planes binary, whole binary"), "planes")
    anchors = (whole.where(F.col("whole").isNotNull()).groupBy("id")
               .agg(F.min(F.struct("label", "size", "whole")).alias("a")).select("id", "a.*"))
    anchors = C.stored(anchors, "anchors")
    n, n_anchors = whole.count(), anchors.count()
    blocks = max(1, -(-n // min(max(CANDIDATES[0], n // (2 * C.shuffle_width(spark))), CANDIDATES[1])))
    sides = max(1, -(-n_anchors // ANCHORS))

    def each(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    cells = whole.select("id", "label", "size", "planes", block.alias("block")).withColumn("side", each(sides))
    side = F.pmod(F.xxhash64("id"), F.lit(sides)).cast("int")

    def meet(asks: DataFrame, job, kind: str) -> DataFrame:
        sent = asks.withColumn("side", side).withColumn("block", each(blocks))
        return (cells.groupBy("block", "side").cogroup(sent.groupBy("block", "side")).applyInArrow(job, kind))

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = (meet(anchors, _positives(positives), "anchor_id long, id long, score long")
             .withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= positives))
    wants = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("wants"))
    asks = C.stored(anchors.join(wants.withColumnRenamed("anchor_id", "id"), "id"), "positives")
    got = meet(asks, _negatives(negatives, low, high),
               "anchor_id long, nth int, positive_id long, id long, positive_score long, score long")
    by_score = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "id")
    return (got.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
