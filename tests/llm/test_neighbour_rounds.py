"""Neighbours over many cells, in several rounds, and per width, against brute force."""

import numpy as np
import pytest

from highwater.llm import ann
from highwater.llm.ann import nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<double>"


def exact(rows, every, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = x @ x[q]
        score[q] = -2
        out[int(ids[q])] = {int(i) for i in ids[np.lexsort((ids, -score))[:k]]}
    return out


def vectors(kind, n, width, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    if kind == "clustered":
        x = 4 * rng.standard_normal((200, width))[rng.integers(0, 200, n)] + x
    return [(i, [float(y) for y in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind", ["clustered", "uniform"])
def test_rounds_keep_the_recall(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "CELL", 256)
    monkeypatch.setattr(ann, "LEAF", 32)
    monkeypatch.setattr(ann, "BLOCK", 16)
    visits, plain = [], ann.materialise

    def noted(df, label):
        out = plain(df, label)
        if label == "visits":
            visits.append(out.selectExpr("coalesce(sum(n), 0) n").first().n)
        return out

    monkeypatch.setattr(ann, "materialise", noted)
    rows = vectors(kind, 8000, 64)
    got = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), every=50).collect()
    want = exact(rows, 50)
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in want}
    assert all(len(f) == 5 for f in found.values())
    assert sum(len(found[q] & want[q]) for q in want) >= 0.9 * 5 * len(want)
    assert visits[0] == len(want) and len(visits) >= 3  # the own cell, and at least two rounds
    if kind == "clustered":
        assert sum(visits[1:]) < 0.55 * len(want) * 31  # the best bound at once would ask for 0.50


def test_every_width_is_an_index(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 64)
    rows = [(0, [1.0])] + [(i, v) for i, v in vectors("clustered", 501, 8)[1:]]
    rows += [(1000 + i, v) for i, v in vectors("uniform", 40, 3)] + [(2000, [1.0, 2.0]), (3000, [5.0] * 5)]
    got = nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    for width in (8, 3):
        mine = [r for r in rows if len(r[1]) == width]
        want = exact(mine, 50)
        for q, ids in want.items():
            assert {r.vec_id for r in got if r.query_id == q} == ids
    assert not [r for r in got if r.query_id in (0, 2000, 3000)]  # nothing of their width
    assert len(got) == 5 * 10 + 5


def test_fewer_candidates_than_asked_for(spark):
    rows = [(i, [1.0, float(i)]) for i in (50, 1, 2)]
    got = nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(50, 1, 2), (50, 2, 1)]
