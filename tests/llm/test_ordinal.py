import random

import numpy as np
import pytest

from ferrolake.llm import ordinal
from ferrolake.llm.queries import op5_quality_classifier

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    grades = ordinal.document_grades(spark.read.parquet(f"{SF}/labels.parquet"))
    return docs, grades


def test_held_out_accuracy(spark, labelled):
    docs, grades = labelled
    model = ordinal.train(docs, grades.where("doc_id % 2 = 0"), 3)
    held = docs.join(grades.where("doc_id % 2 = 1"), "doc_id")
    rows = ordinal.rate(held, model, 2).select("grade", "expected_grade", "tail_probability").collect()
    good = [r for r in rows if r.grade == 2]
    toxic = [r for r in rows if r.grade == 0]
    low = [r for r in rows if r.grade == 1]
    kept = lambda rs: sum(r.tail_probability >= 0.5 for r in rs) / len(rs)
    assert kept(good) > 0.97 and kept(toxic) < 0.05 and kept(low) < 0.35
    means = [np.mean([r.expected_grade for r in rs]) for rs in (toxic, low, good)]
    assert means[0] < means[1] < means[2]
    assert model.thresholds[0] < model.thresholds[1]
    assert len(model.weights) <= ordinal.FEATURES


def test_fit_against_brute_force_gradient():
    """The fit's optimum has no better neighbour under a plain likelihood."""
    rnd = np.random.default_rng(1)
    n, d = 300, 4
    have = rnd.random((n, d)) < 0.4
    z = have @ np.array([2.0, -1.0, 0.5, 0.0]) + rnd.logistic(size=n)
    y = (z > 0).astype(int) + (z > 1.5)
    x, lens = np.nonzero(have)[1], have.sum(axis=1)
    w, t = ordinal.fit_ordinal(x, lens, y, d, 3, penalty=1e-3, steps=1500)

    def loss(w, t):
        up = 1 / (1 + np.exp(-(have @ w)[:, None] + t[None, :]))
        up = np.c_[np.ones(n), up, np.zeros(n)]
        p = up[np.arange(n), y] - up[np.arange(n), y + 1]
        return -np.log(p).mean() + 0.5e-3 * (w ** 2).sum()

    here = loss(w, t)
    for i in range(d):
        for e in (0.05, -0.05):
            assert loss(w + e * np.eye(d)[i], t) > here - 1e-6
    for i in range(2):
        for e in (0.05, -0.05):
            assert loss(w, t + e * np.eye(2)[i]) > here - 1e-6


def test_scores_match_plain_evaluation(spark, labelled):
    docs, grades = labelled
    few = docs.where("doc_id < 60")
    model = ordinal.train(docs, grades, 3, sample=1500)
    again = ordinal.train(docs.repartition(5), grades.repartition(3), 3, sample=1500)
    assert model.weights == again.weights and model.thresholds == again.thresholds
    for r in ordinal.rate(few, model, 1).collect():
        f = ordinal.features(r.text.encode(), ordinal.WordFeatures())
        s = sum(model.weights[x] for x in sorted(f) if x in model.weights)
        p = 1 / (1 + np.exp(-(s - np.array(model.thresholds))))
        assert r.expected_grade == pytest.approx(p.sum()) and r.tail_probability == pytest.approx(p[0])


def test_query(spark):
    got = op5_quality_classifier(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "expected_grade", "tail_probability"]
    rows = got.collect()
    labels = {r.doc_id: r for r in
              spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r.doc_id for r in rows}
    assert all(r.tail_probability >= 0.5 for r in rows)
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in kept for d in clean) / len(clean) > 0.97
    assert sum(d in kept for d, r in labels.items() if r.toxic == 1) <= 1


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "good " * 50000, 7), (None, "x", 8)],
                                 "doc_id long, text string, grade int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ordinal.train(docs, ordinal.document_grades(none), 3) is None
    out = ordinal.select(ordinal.rate(docs, None, 2))
    assert out.count() == 4 and out.first().tail_probability is None
    one = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    assert ordinal.train(docs, ordinal.document_grades(one), 3) is None
    rnd = random.Random(2)
    rows = [(i, ("bad " if i % 3 == 0 else "fine ") + " ".join(rnd.choices("abcdef", k=20)))
            for i in range(90)]
    text = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)]
                                + [(0, 1, 0), (5, None, None), (None, 1, 1)],
                                "doc_id long, quality int, toxic int")
    model = ordinal.train(text, ordinal.document_grades(lab), 3)
    rated = ordinal.rate(docs, model, 2)
    assert rated.columns == ["doc_id", "text", "grade", "expected_grade", "tail_probability"]
    assert rated.count() == 4
    kept = {r.doc_id for r in ordinal.select(ordinal.rate(text, model, 1)).collect()}
    assert kept == {i for i in range(90) if i % 3}
    assert ordinal.rate(docs.limit(0), model, 2).count() == 0
