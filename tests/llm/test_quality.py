import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.llm.quality import BITS, GRADES, accepted, features, fit, label_grades, rate, train
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = C.read(spark, SF, "documents").select("doc_id", "text")
    grades = label_grades(C.read(spark, SF, "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    model = train(docs, grades.where(fold != 0), GRADES)
    assert (np.diff(model.thresholds) > 0).all()
    out = rate(docs.join(grades.where(fold == 0), "doc_id"), model)
    share = {r.grade: r.a for r in out.groupBy("grade").agg(
        F.avg(accepted(F.col("rating")).cast("double")).alias("a")).collect()}
    assert share[2] >= 0.98 and share[1] <= 0.15 and share[0] <= 0.1
    mean = {r.grade: r.e for r in out.groupBy("grade").agg(F.avg("rating.expected").alias("e")).collect()}
    assert mean[0] < mean[1] < mean[2]


def test_query_covers_all(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op2_quality"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.p_good <= r.p_harmless <= 1
        assert r.expected_grade == pytest.approx(r.p_good + r.p_harmless)
        assert r.accepted == (r.p_good >= 0.5)


def test_fit_recovers_order():
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 4, 800)
    doc = np.repeat(np.arange(800), 2)
    feature = np.stack([grade + 10, np.full(800, 5)], axis=1).ravel()
    m = fit(doc, feature, grade, 4)
    w = m.weights[10:14]
    assert w[0] < w[1] and w[1] <= w[2] < w[3] and m.weights[5] == 0
    tails = m.tails(w)
    assert (np.diff(tails, axis=1) < 0).all() and (np.argsort(tails.sum(axis=1)) == np.arange(4)).all()
    assert len(m.weights) == 1 << BITS


def test_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "fine words here"), (4, "bad " * 100000), (5, "x" * 1_500_000), (6, "É!! ÈS!!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("1 as expected", "doc_id", "text", "2 as tail")
    none = spark.createDataFrame([], "doc_id long, grade int")
    out = rate(df, train(df, none, 3))
    assert out.columns == [*df.columns, "rating"]
    assert all(r.rating.expected == pytest.approx(2) for r in out.collect())
    some = spark.createDataFrame([(1, 0), (2, 2), (2, 1), (4, None), (None, 1)], "doc_id long, grade int")
    got = {r.doc_id: r.rating for r in rate(df, train(df, some, 3)).collect()}
    assert len(got) == 6 and got[1].expected == got[2].expected
    assert rate(df.limit(0), train(df, some, 3)).count() == 0
    clash = rate(df.withColumnsRenamed({"tail": "Rating", "expected": "a.b` c"}), train(df, none, 3))
    assert clash.columns == ["a.b` c", "doc_id", "text", "Rating", "rating_"] and clash.count() == 7


def _loss(weights, cuts, doc, feature, grade, prior):
    """Mean negative log-likelihood with the weights' prior, a row at a time."""
    total = 0.0
    for i, g in enumerate(grade.tolist()):
        score = sum(weights[f] for d, f in zip(doc.tolist(), feature.tolist()) if d == i)
        below = [0.0, *(1 / (1 + np.exp(score - c)) for c in cuts), 1.0]
        total -= np.log(below[g + 1] - below[g])
    return total / len(grade) + 0.5 * prior / len(grade) * float((weights ** 2).sum())


def test_fit_against_a_plain_minimum():
    """No step from the fitted weights and thresholds does better, nor does a plain descent by differences."""
    rng = np.random.default_rng(7)
    n = 120
    grade = rng.integers(0, 3, n)
    doc, feature = [], []
    for i, g in enumerate(grade.tolist()):
        for f, p in ((1, 0.2 + 0.3 * g), (2, 0.8 - 0.3 * g), (3, 0.5)):
            if rng.random() < p:
                doc.append(i)
                feature.append(f)
    doc, feature = np.array(doc), np.array(feature)
    m = fit(doc, feature, grade, 3, rounds=1500)
    used = np.flatnonzero(m.weights)
    assert set(used.tolist()) >= {1, 2}

    def loss(theta):
        w = np.zeros(4)
        w[used] = theta[:len(used)]
        return _loss(w, theta[len(used):], doc, feature, grade, 0.3)

    best = np.concatenate([m.weights[used], m.thresholds])
    here = loss(best)
    for _ in range(20):
        assert loss(best + rng.normal(size=len(best)) * 0.05) > here - 1e-6
    theta = np.concatenate([np.zeros(len(used)), [-0.7, 0.7]])
    for _ in range(250):
        slope = np.array([(loss(theta + h) - loss(theta - h)) / 2e-4 for h in 1e-4 * np.eye(len(theta))])
        theta -= 0.8 * slope
    assert abs(loss(theta) - here) < 1e-3 and np.allclose(theta, best, atol=0.1)


def test_query_against_plain_scores(spark):
    """Every text's tails from the sum of its features' weights, one text at a time."""
    sf = "/root/testdata/sf0.001"
    docs = C.read(spark, sf, "documents").select("doc_id", "text")
    model = train(docs, label_grades(C.read(spark, sf, "labels")), GRADES)
    got = {r.doc_id: r for r in QUERIES["op2_quality"](spark, sf).collect()}
    for r in docs.collect():
        data = (r.text or "").encode()
        doc, feature = features(data, np.array([0, len(data) + 1]))
        score = sum(float(model.weights[f]) for f in feature.tolist())
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds.tolist()]
        assert got[r.doc_id].p_harmless == pytest.approx(tails[0]) and got[r.doc_id].p_good == pytest.approx(tails[1])
        assert got[r.doc_id].expected_grade == pytest.approx(sum(tails)) and got[r.doc_id].accepted == (tails[1] >= 0.5)
