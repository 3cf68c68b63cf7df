"""Ranked lexical search by dual trees.

A document is a point whose coordinates are what a term adds to its score; an
item is a point of term weights, and the score is their inner product.  Trees
over the items and over each shard of documents hold the largest coordinate of
every node.  The product of two nodes' coordinates bounds all scores between
them; where it stays below the weakest k-th score of the node's items the whole
batch of pairs is left out, and nothing that belongs in the result is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C

#: Documents, and terms of documents, in a shard.
SHARD_DOCS, SHARD_TERMS = 4_096, 1 << 20
#: Terms of items in a block, about.
BLOCK_TERMS = 1 << 15
#: Distinct item terms that tasks get to pick those of the documents (8 MB);
#: beyond, documents keep all their terms.
VOCABULARY = 1 << 20
#: Documents and items in a leaf.
DOC_LEAF, ITEM_LEAF = 8, 16
#: One of so many shards is searched first, for the scores that the others must reach.
FIRST = 16
#: Power iterations for a node's direction.
ROUNDS = 4
#: Bytes of leaf matrices that a search keeps at hand.
MATRICES = 64 << 20

_LAST = np.iinfo(np.int64).max


class Points:
    """Sparse rows of positive integers over ``size`` columns."""

    def __init__(self, sizes: np.ndarray, column: np.ndarray, value: np.ndarray, size: int):
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.column, self.value, self.size = column, value, size

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and the number of its row for each."""
        n = self.start[rows + 1] - self.start[rows]
        which = np.repeat(np.arange(len(rows)), n)
        return np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.start[rows][which], which

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.size), np.int64)
        at, which = self.entries(rows)
        out[which, self.column[at]] = self.value[at]
        return out

    def largest(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size, np.int64)
        at, _ = self.entries(rows)
        np.maximum.at(out, self.column[at], self.value[at])
        return out


class Tree:
    """Halves of halves: node i holds order[first[i]:end[i]], children are 0 for leaves."""

    def __init__(self, points: Points, scale: np.ndarray, leaf: int):
        n = len(points.start) - 1
        self.order, self.leaf = np.arange(n), leaf
        self.first, self.end, self.left, self.right = [0], [n], [0], [0]
        k = 0
        while k < len(self.first):
            a, b = self.first[k], self.end[k]
            if b - a > leaf:
                self.order[a:b] = self._sorted(points, scale, self.order[a:b])
                cut = (a + b) // 2
                self.left[k], self.right[k] = len(self.first), len(self.first) + 1
                self.first += [a, cut]
                self.end += [cut, b]
                self.left += [0, 0]
                self.right += [0, 0]
            k += 1

    @staticmethod
    def _sorted(points: Points, scale: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows along the direction in which they differ most, about: a few
        power iterations over rows of length one, from a fixed start."""
        at, which = points.entries(rows)
        column = points.column[at]
        value = points.value[at] * scale[column]
        length = np.sqrt(np.bincount(which, value * value, len(rows)))
        value /= np.where(length > 0, length, 1)[which]
        line = np.random.default_rng(0).standard_normal(points.size)
        for _ in range(ROUNDS):
            along = np.bincount(which, value * line[column], len(rows))
            along -= along.mean()
            line = np.bincount(column, value * along[which], points.size)
            line /= np.abs(line).max(initial=0) or 1
        return rows[np.argsort(np.bincount(which, value * line[column], len(rows)), kind="stable")]

    def rows(self, k: int) -> np.ndarray:
        return self.order[self.first[k]:self.end[k]]


class Search:
    """The ``k`` best documents of every item within one cell.

    ``floor``: scores that an item's answers must reach.  Equal scores are
    ordered by id.  ``scored`` counts the pairs whose score was computed.
    """

    def __init__(self, docs: Points, ids: np.ndarray, items: Points, floor: np.ndarray, k: int):
        self.docs, self.ids, self.items, self.k = docs, ids, items, k
        self.floor = np.maximum(floor, 1)
        heaviest = items.largest(np.arange(len(floor)))
        self.doc_tree = Tree(docs, heaviest.astype(float), DOC_LEAF)
        self.item_tree = Tree(items, np.ones(items.size), ITEM_LEAF)
        self.top = self._doc_maxima()
        self.asks = [self._item_node(n) for n in range(len(self.item_tree.first))]
        total = np.bincount(items.entries(np.arange(len(floor)))[1], items.value, len(floor))
        most = float(docs.value.max(initial=0)) * float(total.max(initial=0))
        self.exact = np.float64 if most < 2**53 else np.int64  # either way without rounding
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in floor]
        self.scored, self.kept_bytes, self.kept = 0, 0, {}

    def _doc_maxima(self) -> np.ndarray:
        t = self.doc_tree
        top = np.zeros((len(t.first), self.docs.size), np.int32)
        for n in range(len(t.first) - 1, -1, -1):
            top[n] = np.maximum(top[t.left[n]], top[t.right[n]]) if t.left[n] else self.docs.largest(t.rows(n))
        return top

    def _item_node(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Columns of the node, their largest weights, and of a leaf the weights of each item."""
        rows = self.item_tree.rows(n)
        at, which = self.items.entries(rows)
        column, place = np.unique(self.items.column[at], return_inverse=True)
        largest = np.zeros(len(column), np.int64)
        np.maximum.at(largest, place, self.items.value[at])
        weights = None
        if not self.item_tree.left[n]:
            weights = np.zeros((len(column), len(rows)), np.int64)
            weights[place, which] = self.items.value[at]
        return column, largest, weights

    def bounds(self, item_node: int, doc_node: int) -> np.ndarray:
        """What no score between the nodes exceeds: for all items of an inner
        node at once, for those of a leaf one by one."""
        column, largest, weights = self.asks[item_node]
        each = largest[:, None] if weights is None else weights
        return (self.top[doc_node].take(column).astype(self.exact) @ each.astype(self.exact)).astype(np.int64)

    def open(self, item_node: int, bounds: np.ndarray) -> np.ndarray:
        """Which of the bounds reach the weakest k-th score that they speak for."""
        floor = self.floor[self.item_tree.rows(item_node)]
        return bounds >= (floor if self.asks[item_node][2] is not None else floor.min())

    def matrix(self, doc_node: int) -> np.ndarray:
        if doc_node not in self.kept:
            if self.kept_bytes > MATRICES:
                self.kept, self.kept_bytes = {}, 0
            got = self.docs.dense(self.doc_tree.rows(doc_node)).astype(np.int32)
            self.kept[doc_node] = got
            self.kept_bytes += got.nbytes
        return self.kept[doc_node]

    def leaves(self, item_node: int, doc_node: int, live: np.ndarray) -> None:
        column, _, weights = self.asks[item_node]
        weights = weights[:, live]
        score = (self.matrix(doc_node)[:, column].astype(self.exact) @ weights.astype(self.exact)).astype(np.int64)
        self.scored += score.size
        items, ids = self.item_tree.rows(item_node)[live], self.ids[self.doc_tree.rows(doc_node)]
        for c in np.flatnonzero((score >= self.floor[items]).any(axis=0)):
            i = items[c]
            good = np.flatnonzero(score[:, c] >= self.floor[i])
            s, d = (np.concatenate(x) for x in zip(self.found[i], (score[good, c], ids[good]), strict=True))
            by = np.lexsort((d, -s))[:self.k]
            self.found[i] = s[by], d[by]
            if len(by) == self.k:
                self.floor[i] = max(self.floor[i], s[by[-1]])

    def run(self) -> None:
        items, docs = self.item_tree, self.doc_tree
        if not len(self.ids) or not len(self.floor):
            return
        stack = [(0, 0, self.bounds(0, 0))]
        while stack:
            q, d, most = stack.pop()
            live = self.open(q, most)
            if not live.any():
                continue
            if not items.left[q] and not docs.left[d]:
                self.leaves(q, d, live)
                continue
            qs = (items.left[q], items.right[q]) if items.left[q] else (q,)
            ds = (docs.left[d], docs.right[d]) if docs.left[d] else (d,)
            stack += sorted(((x, y, self.bounds(x, y)) for x in qs for y in ds), key=lambda n: n[2].max())  # best on top


def _unique(words: np.ndarray, doc: np.ndarray, known: np.ndarray | None):
    """Distinct (document, known word) with counts, by document and word."""
    names = np.unique(words) if known is None else known
    at = np.searchsorted(names, words)
    at[at == len(names)] = 0
    good = names[at] == words if len(names) else np.zeros(len(words), bool)
    key, count = np.unique(doc[good] * max(len(names), 1) + at[good], return_counts=True)
    return key // max(len(names), 1), names[key % max(len(names), 1)], count


def _terms(known: np.ndarray | None):
    """(id, text) to (id, words, terms and counts as bytes)."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            words, terms, counts = [], [], []
            for a, b, data, at in C.doc_groups(texts):
                s, _, v = C.scan_words(data, C.IS_ALNUM, C.FOLD)
                first = np.searchsorted(s, at)
                words.append(np.diff(first))
                doc, term, count = _unique(v, np.repeat(np.arange(b - a), words[-1]), known)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                count = count.astype(np.int32)
                for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    terms.append(term[x:y].tobytes())
                    counts.append(count[x:y].tobytes())
            n = np.concatenate([*words, np.zeros(0, np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(terms, pa.binary()),
                                              pa.array(counts, pa.binary())], ["id", "n", "terms", "counts"])
    return run


TERMS = "id long, n long, terms binary, counts binary"


def _numbers(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _one_by_one(batches):
    """A row for each term of a document or item."""
    for batch in batches:
        terms, count = _numbers(batch.column("terms"), np.int64), _numbers(batch.column("counts"), np.int32)
        size = np.array([len(x) // 8 for x in batch.column("terms").to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("id").to_numpy(), size)), pa.array(terms), pa.array(count)],
            ["id", "term", "count"])


def _frequencies(batches):
    """How many documents of a task's part hold each term, flushed when a million are held."""
    held, n = [], 0

    def flush():
        term, place = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        count = np.bincount(place, np.concatenate([c for _, c in held]), len(term)).astype(np.int64)
        return term, count

    for batch in batches:
        term, count = np.unique(_numbers(batch.column("terms"), np.int64), return_counts=True)
        held.append((term, count))
        n += len(term)
        if n > 1 << 20:
            held = [flush()]
            n = len(held[0][0])
            if n > 1 << 19:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["term", "df"])
                held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush()], ["term", "df"])


def _cell(k: int):
    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        found = [(none, none, none)]
        if docs.num_rows and items.num_rows:
            size = np.array([len(x) // 8 for x in items.column("terms").to_pylist()], np.int64)
            wanted, at = np.unique(_numbers(items.column("terms"), np.int64), return_inverse=True)
            asks = Points(size, at, _numbers(items.column("weights"), np.int64), len(wanted))
            size = np.array([len(x) // 8 for x in docs.column("terms").to_pylist()], np.int64)
            terms, count = _numbers(docs.column("terms"), np.int64), _numbers(docs.column("counts"), np.int32)
            at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
            good = wanted[at] == terms
            doc = np.repeat(np.arange(len(size)), size)[good]
            m, tf = docs.column("m").to_numpy()[doc], count[good].astype(np.int64)
            part = Points(np.bincount(doc, minlength=len(size)), at[good],
                          (1_000_000_000 * tf) // (1000 * tf + 12 * m), len(wanted))
            search = Search(part, docs.column("id").to_numpy(), asks, items.column("floor").to_numpy().copy(), k)
            search.run()
            keys = items.column("id").to_numpy()
            found += [(np.full(len(s), keys[i]), d, s) for i, (s, d) in enumerate(search.found)]
        item, doc, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"item": item, "id": doc, "score": score})
    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc id and score of the ``k`` documents with the
    highest scores above 0 for each item (all, if fewer); equal scores by id.

    Terms are runs of letters, digits and all beyond ASCII, A-Z lower-cased,
    told apart by 64-bit values (n distinct ones give about n^2 / 2^65 chance
    collisions).  With N documents that hold a term, L terms in all, n of them
    in a document, tf of one term there and df documents that hold it: a term
    weighs floor(1000 ln((2 N + 2) / (2 df + 1))), a document's m is
    75 + (25 n N) div L, and the score sums, over the item's terms with repeats,
    weight * ((10^9 tf) div (1000 tf + 12 m)).

    Null and empty texts have no terms: such documents are no answers, such
    items get none.  Documents without id take part and come last among equal
    scores.  Repeated documents all count; equal items count once, items that
    share an id but not the text are ranked each for itself.  An empty table on
    either side gives no rows.  An item must hold no more than some 3 * 10^8
    terms, as scores are 64-bit integers.
    """
    spark = docs.sparkSession
    asked = items.select(items[item_id].alias("item_id"), items[item_text].alias("text")).distinct()
    asked = C.stored(asked.withColumn("id", F.monotonically_increasing_id()), "items")
    wanted = C.stored(asked.select("id", "text").mapInArrow(_terms(None), TERMS)
                      .select("id", "terms", "counts").mapInArrow(_one_by_one, "id long, term long, count int"), "item-terms")
    names = wanted.select("term").distinct()
    known = None
    if names.limit(VOCABULARY + 1).count() <= VOCABULARY:
        known = np.unique(names.toArrow().column("term").to_numpy().view(np.uint64))
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("id"),
                       docs[text_col].alias("text")).where("text is not null")
    rows = C.stored(rows.mapInArrow(_terms(known), TERMS).where("n > 0"), "document-terms")
    all_docs, all_words, entries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)),
                                            F.coalesce(F.sum(F.octet_length("terms")), F.lit(0)) / 8).first()
    df = rows.select("terms").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    share = F.lit(2 * all_docs + 2).cast("double") / (2 * F.col("df") + 1)
    weight = df.select("term", F.floor(1000 * F.log(share)).cast("long").alias("weight")).where("weight > 0")
    entry = F.struct("term", (F.col("weight") * F.col("count")).alias("weight"))
    asks = wanted.join(weight, "term").groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    asks = C.stored(asks.mapInArrow(_packed_items, "id long, terms binary, weights binary"), "weighted-items")
    blocks = max(1, -(-int((asks.agg(F.sum(F.octet_length("terms"))).first()[0] or 0) // 8) // BLOCK_TERMS))
    shards = max(1, -(-all_docs // SHARD_DOCS), -(-int(entries) // SHARD_TERMS))
    first = -(-shards // FIRST)

    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    m = (75 + F.expr(f"cast(25 * cast(n as decimal(38, 0)) * {all_docs} as decimal(38, 0)) div {max(all_words, 1)}"))
    cells = rows.select("id", m.cast("long").alias("m"), "terms", "counts", shard.alias("shard"))
    cells = cells.where(F.octet_length("terms") > 0).withColumn("block", _each(0, blocks))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    def search(asks: DataFrame, a: int, b: int) -> DataFrame:
        sent = asks.withColumn("block", block).withColumn("shard", _each(a, b))
        mine = cells.where((F.col("shard") >= a) & (F.col("shard") < b))
        return (mine.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block"))
                .applyInArrow(_cell(k), "item long, id long, score long"))

    def top(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    got = C.stored(top(search(asks.withColumn("floor", F.lit(0).cast("long")), 0, first)), "first-shards")
    if first < shards:
        floor = got.where(F.col("rank") == k).select(F.col("item").alias("id"), F.col("score").alias("floor"))
        raised = asks.join(floor, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("long")))
        got = top(got.drop("rank").unionByName(search(raised, first, shards)))
    named = asked.select(F.col("id").alias("item"), "item_id")
    return got.join(named, "item").select(
        "item_id", "rank", F.nullif("id", F.lit(_LAST)).alias(id_col), "score")


def _each(a: int, b: int):
    return F.explode(F.sequence(F.lit(a), F.lit(b - 1)))


def _packed_items(batches):
    for batch in batches:
        entries = batch.column("entries").to_pylist()
        terms, weights = ([np.array([e[x] for e in row], np.int64).tobytes() for row in entries]
                          for x in ("term", "weight"))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(terms, pa.binary()),
                                          pa.array(weights, pa.binary())], ["id", "terms", "weights"])
