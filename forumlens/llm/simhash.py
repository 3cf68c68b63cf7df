"""SimHash near-duplicates through BK-trees.

Fingerprints of 64 bits are cut into bands.  With ``agree`` bands more than the
radius, two fingerprints within the radius agree in ``agree`` bands at least, so a
shard is all fingerprints with the same values of so many bands, of each as many
bits as leave a shard some ``SHARD`` fingerprints, and no link crosses shards
unseen.  Each shard has a BK-tree of its own, built and searched in the task that
holds it: the trees together grow with the corpus, so they are not broadcast.  A
shard of more than ``MOST`` fingerprints is cut into blocks, and each pair of
blocks is a task: the tree of one, searched by the other.  Equal fingerprints
shrink to one before; a shard answers with a star per class, not with pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.llm.bk_tree import Classes, Tree, link
from forumlens.llm.components import components

SEED = 42
SHARD = 4_096  # fingerprints in a shard, about
MOST = 65_536  # in a block of a larger shard
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Bit k is 1 if it is in over half of the shingles' XXH64 values."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size)
    starts, ends = (end - size).tolist(), (end - 1).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)),
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        part = h[a:a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            found = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle)
                                 for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("version"), pa.array(found.view(np.int64))],
                ["id", "version", "print"])
    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, version, print): version is a hash of the text that tells rows with
    one id apart."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs[text_col]
    return (docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("version"),
                        text.cast("binary").alias("text"))
            .mapInArrow(_fingerprints(shingle), f"id {kind}, version long, print long"))


def shard_masks(n: int, radius: int, size: int) -> list[int]:
    """Masks such that two fingerprints within ``radius`` bits agree under one at
    least, wide enough for shards of about ``size`` of ``n`` fingerprints."""
    bits = max(0, (max(n, 1) // size).bit_length() - 1)
    agree = 1
    while 64 // (radius + agree) * agree < bits and agree < 4:
        agree += 1
    bands = radius + agree
    each = min(64 // bands, -(-bits // agree))
    cuts = [64 * k // bands for k in range(bands)]
    return [sum(((1 << each) - 1) << cuts[k] for k in some) for some in combinations(range(bands), agree)]


def _stars(radius: int):
    """One shard, or a pair of blocks of one: the tree of the first block, searched by the second."""
    def run(group: pa.Table) -> pa.Table:
        prints = group.column("print").to_numpy().view(np.uint64)
        mine = group.column("block").to_numpy() == group.column("tree").to_numpy()
        tree, others = np.sort(prints[mine]), np.sort(prints[~mine])
        within = group.column("tree")[0].as_py() == group.column("search")[0].as_py()
        both = tree if within else np.concatenate([tree, others])
        same = Classes(len(both))
        link(Tree(tree), tree if within else others, radius, same, 0 if within else len(tree))
        root = same.of(np.arange(len(both)))
        linked = root != np.arange(len(both))
        return pa.table({"u": both[linked].view(np.int64), "v": both[root[linked]].view(np.int64)})
    return run


def _blocks(shards: DataFrame, most: int) -> DataFrame:
    """(print, mask, value, block, tree, search): the rows of a shard; of one with
    more than ``most`` a row for each pair of blocks that a fingerprint's block is in."""
    large = shards.groupBy("mask", "value").count().where(F.col("count") > most)
    large = large.select("mask", "value", F.ceil(F.col("count") / most).cast("int").alias("blocks"))
    # at most len(masks) * n / most rows
    rows = shards.join(F.broadcast(large), ["mask", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("print", F.lit("block")), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.select("print", "mask", "value", "block", other.alias("other")).select(
        "print", "mask", "value", "block", F.least("block", "other").alias("tree"), F.greatest("block", "other").alias("search"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4) -> DataFrame:
    """Per row of ``docs``: ``id_col``, version (xxhash64 of the text),
    fingerprint (16 hex digits), class (a fingerprint that names the class) and
    component_id, the least id that the row's fingerprint reaches over links of
    at most ``radius`` differing bits.

    Words are split at white space, A-Z lower-cased; a text of fewer words than
    a shingle is one shingle; null and empty texts have the fingerprint zero and
    link like any other.  Ids may repeat or be null; a class without any id has
    the component null.  Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = C.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    prints = rows.groupBy("print").agg(F.min("id").alias("least_id"))
    distinct = C.stored(rows.select("print").distinct(), "prints")
    masks = shard_masks(distinct.count(), radius, SHARD)
    shard = F.explode(F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("print").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("value"))
        for k, m in enumerate(masks)]))
    shards = distinct.select("print", shard.alias("s")).select("print", "s.*")
    cells = ["mask", "value", "tree", "search"]
    links = (_blocks(shards, MOST).repartition(C.shuffle_width(spark), *cells).groupBy(*cells)
             .applyInArrow(_stars(radius), "u long, v long"))
    roots = components(links)
    named = prints.join(roots, prints["print"] == roots["node"], "left")
    named = C.stored(named.select("print", "least_id", F.coalesce("root", "print").alias("root")), "roots")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    width = C.shuffle_width(spark)
    of = C.stored(named.join(least.repartition(width), "root").select("print", "root", "component_id"), "classes")
    out = rows.join(of, "print")
    digits = [F.lower(F.lpad(F.hex(c), 16, "0")).alias(n) for c, n in (("print", "fingerprint"), ("root", "class"))]
    return out.select(F.col("id").alias(id_col), "version", *digits, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate class: that of the least
    id (rows without an id come first), of several such texts the one of least
    hash, of equal rows any one."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    one = found.groupBy("class").agg(F.min(F.struct(id_col, "version")).alias("kept"))
    one = one.select(F.col(f"kept.{id_col}").alias("kept_id"), F.col("kept.version").alias("kept_version"))
    version = C.free_name(docs, "version")
    rows = docs.withColumn(version, F.xxhash64(docs[text_col]))
    rows = rows.join(one, rows[id_col].eqNullSafe(one["kept_id"]) & (rows[version] == one["kept_version"]),
                     "left_semi")
    return rows.dropDuplicates([id_col, version]).select(*docs.columns)
