"""Nearest vectors and similar pairs against brute force, with clusters, copies, ties and empty tables."""

import numpy as np
import pytest

from basketry.operators import vectors

SCHEMA = "id long, vector array<double>"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    matrix = centres[rng.integers(0, 40, 1500)] + 0.35 * rng.standard_normal((1500, 24))
    matrix[::9] = matrix[0]  # one vector in a ninth of all rows
    matrix[1::50] = matrix[2] + 0.01 * rng.standard_normal((30, 24))
    return matrix


@pytest.fixture(scope="module")
def rows(spark, data):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)] + [(5000, None), (None, data[3].tolist()), (5001, [0.0] * 24), (5002, [float("inf")] * 24)], SCHEMA).repartition(4).cache()


def unit(data):
    return data / np.linalg.norm(data, axis=1, keepdims=True)


def wanted(data, k):
    scores = unit(data) @ unit(data).T
    np.fill_diagonal(scores, -np.inf)
    return {q: set(np.lexsort((np.arange(len(data)), -np.round(scores[q], 12)))[:k].tolist()) for q in range(0, len(data), 50)}, scores


@pytest.mark.parametrize("rows_of_block", [100, 16384])
def test_exact_neighbours(rows, data, monkeypatch, rows_of_block):
    monkeypatch.setattr(vectors, "ROWS", rows_of_block)
    monkeypatch.setattr(vectors, "QUERIES", 7)
    got = vectors.nearest_vectors(rows.where("id % 50 = 0 AND id < 1500"), rows, 10).collect()
    want, scores = wanted(data, 10)
    for q, best in want.items():
        own = sorted((r for r in got if r.query == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert np.allclose([r.similarity for r in own], sorted((scores[q, list(best)]), reverse=True))
    assert vectors.nearest_vectors(rows.limit(0), rows, 3).count() == vectors.nearest_vectors(rows, rows.limit(0), 3).count() == 0


def test_recall_of_the_inverted_file(rows, data, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS", 200)
    clean = vectors.units(rows).where("id < 1500")
    index = vectors.fit_nearest(clean, 10, 0.95, sample=800, lists=40)
    assert index.probes < 20 and len(index.centres) == 40  # most lists are not visited
    got = vectors.nearest_indexed(rows.where("id % 50 = 0 AND id < 1500"), rows, 10, sample=800, lists=40).collect()
    want, scores = wanted(data, 10)
    limit = {q: min(scores[q, list(best)]) for q, best in want.items()}
    found = sum(r.similarity >= limit[r.query] - 1e-12 for r in got)
    assert found >= 0.9 * 10 * len(want) and len(got) == 10 * len(want)
    assert vectors.nearest_indexed(rows, rows.limit(0), 3).count() == 0


def test_groups_and_their_pairs(spark, rows, data):
    members, pairs = vectors.similar_groups(rows, 0.95, sample=800)
    least = {}
    for i, v in enumerate(data):
        least.setdefault(tuple(v), i)
    want = {i: least[tuple(v)] for i, v in enumerate(data)}
    assert {r.id: r.group for r in members.collect()} == want and members.count() == len(want)
    named = sorted(least.values())
    scores = unit(data[named]) @ unit(data[named]).T
    close = {(named[i], named[j]) for i, j in zip(*np.nonzero(np.triu(scores >= 0.95, 1)))}
    assert len(close) > 400 and {(r.a, r.b) for r in pairs.collect()} == close
    none = vectors.similar_groups(rows.limit(0), 0.95)
    assert none[0].count() == none[1].count() == 0
