from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.quality import _descend, _ratios, features, fit, score, train

WORDS = [f"word{i}" for i in range(200)]


def made(i, draw):
    good = " ".join(draw.choice(WORDS) for _ in range(draw.randrange(8, 60))).capitalize() + "."
    kind = i % 4
    bad = [good.upper().replace(" ", "!! "), " ".join([draw.choice(WORDS)] * 30), good.replace(" ", "%%% ")][i % 3]
    return (good, 1) if kind else (bad, 0)


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(3)
    rows = [(i, *made(i, draw)) for i in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").cache()
    return docs, spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int").cache()


def test_held_out_documents_are_told_apart(tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in score(docs, fit(docs, labels)).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) > 150 and sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_teach_nothing(tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality", "toxic")
    one, other = fit(docs, labels), fit(docs, flipped)
    assert np.array_equal(one.weights, other.weights) and one.shift == other.shift


def test_descent_reaches_the_dual_optimum():
    """At the optimum each dual variable is at its bound or the margin is as the conditions ask."""
    draw = np.random.default_rng(1)
    rows = [np.sort(draw.choice(40, 12, replace=False)) for _ in range(80)]
    y = np.where([(3 in r) for r in rows], 1.0, -1.0)
    ratio = _ratios(rows, y)
    weight, bias = _descend(rows, y, ratio, 0.5, 3000, 0)
    margins = np.array([s * (weight[r] @ (ratio[r] / np.sqrt(12)) + bias) for r, s in zip(rows, y, strict=True)])
    primal = 0.5 * (weight @ weight + bias**2)
    share = {-1.0: (y < 0).mean(), 1.0: (y > 0).mean()}
    bounds = np.array([0.5 / (2 * share[s]) for s in y])
    primal += (bounds * np.maximum(0, 1 - margins)).sum()
    nudged = [(weight + 0.01 * draw.standard_normal(len(weight)), bias + 0.01 * draw.standard_normal()) for _ in range(50)]
    for w, b in nudged:
        m = np.array([s * (w[r] @ (ratio[r] / np.sqrt(12)) + b) for r, s in zip(rows, y, strict=True)])
        assert 0.5 * (w @ w + b**2) + (bounds * np.maximum(0, 1 - m)).sum() >= primal - 1e-6


def test_features_of_long_texts_are_those_of_the_whole():
    long = "abc DEF 123 !? " * 200_000
    (places,), (short,) = features(pa.array([long])), features(pa.array(["abc DEF 123 !? abc DEF 123 !? "]))
    assert set(short.tolist()) - set(places.tolist()) == set() or len(set(short.tolist()) ^ set(places.tolist())) <= 8
    assert len(next(features(pa.array([None], pa.string())))) == 0


def test_edges(edge_docs, no_docs, spark, tables):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score(edge_docs, fit(edge_docs, none)).collect()} == {0.5}
    same = spark.createDataFrame([(4, 1), (4, 1), (6, 1), (9, None), (None, 1)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in score(edge_docs, fit(edge_docs, same)).collect())
    rows = score(edge_docs, fit(*tables)).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert score(no_docs, train([], np.zeros(0))).count() == 0
