"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is the set of its hashed features: its words (letters and digits, A-Z
lower-cased), the shapes of its words (runs of capitals, letters, digits and
each mark) and steps of how many words repeat.  One weight per feature is shared
by all grades; ordered thresholds cut the score into grades:
P(grade <= k) = sigmoid(threshold[k] - score).  Expected grade and tail
probabilities P(grade >= k) follow.

The fit sees a bounded sample of rated texts (``max_rated`` in expectation, each
of at most ``max_bytes``); scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm import common as C

BITS = 18
MAX_RATED = 12_000
MAX_BYTES = 1 << 15
#: Features of fewer rated texts than this have no weight, nor have those whose
#: texts' mean grade is within so many standard errors of the mean of all.
LEAST_TEXTS = 4
LEAST_SIGNAL = 3.0
#: Bytes as shapes: capitals A, other letters a (all beyond ASCII too), digits 0.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x41:0x5B] = 0x41
SHAPE[0x61:0x7B] = SHAPE[0x80:] = 0x61
SHAPE[0x30:0x3A] = 0x30
SHAPE[list(C.SPACES)] = 0x20


def _shapes(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the words' shapes, equal neighbours merged, and each one's text."""
    kind = SHAPE[np.frombuffer(data, np.uint8)]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[at[1:-1] - 1] = True  # the line feed between two texts
    place = np.flatnonzero(first)
    s, _, v = C.scan_words(kind[place].tobytes(), C.IS_SPACED)
    return v, np.searchsorted(at, place[s], side="right") - 1


def _distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a text's features each once: sorted texts and hashed features."""
    key = np.unique((doc.astype(np.int64) << BITS) | (value & np.uint64((1 << BITS) - 1)).astype(np.int64))
    return key >> BITS, key & ((1 << BITS) - 1)


def features(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs of joined texts with offsets ``at``, sorted."""
    n = len(at) - 1
    s, _, words = C.scan_words(data, C.IS_ALNUM, C.FOLD)
    doc = np.searchsorted(at, s, side="right") - 1
    shape, shape_doc = _shapes(data, at)
    count = np.bincount(doc, minlength=n)
    twice = np.bincount(doc[1:][(words[1:] == words[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    apart = np.unique((doc.astype(np.uint64) << np.uint64(48)) | (words >> np.uint64(16)))
    unlike = np.bincount((apart >> np.uint64(48)).astype(np.int64), minlength=n)
    size = np.maximum(count, 1)
    steps = [np.searchsorted([0.02, 0.1, 0.3], twice / size),
             np.searchsorted([0.2, 0.4, 0.6, 0.8, 0.95], unlike / size) * 32 + np.log2(size).astype(int)]
    extra = [C.mix(step.astype(np.uint64) + np.uint64((k + 1) << 40)) for k, step in enumerate(steps)]
    every = np.arange(n)
    return _distinct(np.concatenate([doc, shape_doc, every, every]),
                     np.concatenate([words, C.mix(shape ^ np.uint64(0x5AFE)), *extra]))


@dataclass
class Model:
    weights: np.ndarray  # one per hashed feature
    thresholds: np.ndarray  # ascending, one less than grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))

    def scores(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, self.weights[feature], minlength=n)


def fit(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int, rounds: int = 150,
        prior: float = 0.3, rate: float = 0.05) -> Model:
    """The cumulative-link model by Adam over all rows; ``prior`` is the
    precision of the weights' normal prior."""
    n = len(grade)
    l2 = prior / max(n, 1)
    texts = np.bincount(feature, minlength=1 << BITS)
    off = np.bincount(feature, (grade - grade.mean())[doc] if n else None, minlength=1 << BITS)
    error = (grade.std() if n else 0.0) * np.sqrt(texts)
    use = (texts >= LEAST_TEXTS) & (np.abs(off) > LEAST_SIGNAL * error)
    keep = use[feature]
    doc, feature = doc[keep], feature[keep]
    kept = np.flatnonzero(use)
    column = np.searchsorted(kept, feature)
    by = np.argsort(column, kind="stable")
    by_doc, by_column = doc[by], column[by]
    start_doc = np.searchsorted(doc, np.arange(n))
    start_column = np.searchsorted(by_column, np.arange(len(kept)))
    full = np.diff(np.append(start_doc, len(doc))) > 0

    def spread(x: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if len(column):
            out[full] = np.add.reduceat(x[column], start_doc[full])
        return out

    if not n:
        return Model(np.zeros(1 << BITS), np.full(grades - 1, -60.0))
    low = np.clip([(grade <= k).mean() for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    cut = np.log(low / (1 - low))
    # thresholds: the first, then logarithms of the gaps, so that they stay in order
    theta = np.concatenate([np.zeros(len(kept)), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for step in range(1, rounds + 1):
        w, gaps = theta[:len(kept)], np.exp(theta[len(kept) + 1:])
        t = np.cumsum(np.concatenate([theta[len(kept):len(kept) + 1], gaps]))
        score = spread(w)
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(np.clip(score[:, None] - t, -60, 60))),
                                np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        p = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-9)
        up, down = slope[rows, grade + 1] / p, slope[rows, grade] / p
        g_score = (up - down) / n  # of the mean negative log-likelihood
        g_t = np.zeros((n, grades + 1))
        g_t[rows, grade + 1] -= up / n
        g_t[rows, grade] += down / n
        g_t = g_t.sum(axis=0)[1:-1]
        tail = np.cumsum(g_t[::-1])[::-1]
        g_w = np.add.reduceat(g_score[by_doc], start_column) if len(kept) else np.zeros(0)
        g = np.concatenate([g_w + l2 * w, tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    weights = np.zeros(1 << BITS)
    weights[kept] = theta[:len(kept)]
    gaps = np.exp(theta[len(kept) + 1:])
    return Model(weights, np.cumsum(np.concatenate([theta[len(kept):len(kept) + 1], gaps])))


def _featurize(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = []
        for a, b, data, at in C.doc_groups(texts):
            doc, feature = features(data, at)
            cuts = np.searchsorted(doc, np.arange(b - a + 1))
            found += [feature[i:j].astype(np.int32).tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(found, pa.binary())],
                                         ["grade", "features"])


def train(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text",
          max_rated: int = MAX_RATED, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on ``ratings`` (``id_col``, grade 0 .. grades - 1; null grades don't
    count, the lowest of several does).  Without any rated text every text gets
    the highest grade."""
    rated = (ratings.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("rated_id")).agg(F.min("grade").cast("int").alias("grade")))
    n = rated.count()
    some = rated.where(F.pmod(F.xxhash64("rated_id", F.lit("rated")), F.lit(1_000_000))
                       < 1e6 * max_rated / max(n, max_rated))
    # the sample is bounded by ``max_rated``, and so is what is broadcast
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(
        F.broadcast(some), F.col("id") == F.col("rated_id"))
    rows = rows.where(F.octet_length("text") <= max_bytes).select("grade", "text")
    got = rows.mapInArrow(_featurize, "grade int, features binary").toArrow()
    grade = got.column("grade").to_numpy().astype(np.int64)
    parts = [np.frombuffer(x, np.int32) for x in got.column("features").to_pylist()]
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    feature = np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int64)
    return fit(doc, feature, grade, grades)


def _rate(model: Model, text_at: int):
    grades = len(model.thresholds) + 1

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            tails = []
            for a, b, data, at in C.doc_groups(texts):
                tails.append(model.tails(model.scores(*features(data, at), b - a)))
            tail = np.concatenate([*tails, np.zeros((0, grades - 1))])
            rating = pa.StructArray.from_arrays(
                [pa.array(tail.sum(axis=1)),
                 pa.ListArray.from_arrays(np.arange(0, tail.size + 1, grades - 1, dtype=np.int32),
                                          pa.array(tail.ravel()))], ["expected", "tail"])
            yield pa.RecordBatch.from_arrays([*batch.columns, rating], [*batch.schema.names, "made"])
    return run


def rate(docs: DataFrame, model: Model, text_col: str = "text", result: str = "rating") -> DataFrame:
    """``docs`` with a struct column ``result``: expected (grade) and tail, an
    array whose k-th entry is P(grade >= k), from k = 1.

    Null and empty texts have only the features of a text of no words; equal
    texts fare alike; an empty table stays empty; other columns stay.  If
    ``docs`` has a column ``result`` the new one gets underscores.
    """
    kind = T.StructType.fromDDL("expected double, tail array<double>")
    return C.add_in_arrow(docs, _rate(model, docs.columns.index(text_col)), C.free_name(docs, result), kind)


#: Grades of the table ``labels``: harmful, poor, good.
GRADES = 3


def label_grades(labels: DataFrame) -> DataFrame:
    """Toxic texts are the lowest grade, others go by their quality."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def accepted(rating: Column, least: float = 0.5) -> Column:
    """Good with a probability of ``least`` or more."""
    return rating["tail"][GRADES - 2] >= least
