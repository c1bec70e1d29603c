"""Nearest neighbours and hard negatives against plain searches."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixwright.llm import hard_negatives, neighbours
from mixwright.llm.vectors import products

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, vec string, t string, bucket string, part string, score string"


def table(spark, rows):
    """rows of (vec_id, vector, label), with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, *"abcdef") for i, v, label in rows], SCHEMA)


def clustered(n, dim=24, copies=300, seed=3):
    """Clusters, one vector that a third of the rows share, near copies of it, and lone vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, dim))
    x = np.where(rng.random((n, 1)) < 0.5, centres[rng.integers(0, 20, n)] + 0.4 * rng.standard_normal((n, dim)), rng.standard_normal((n, dim)))
    x[:copies] = centres[0]
    x[copies : copies + 50] = centres[0] + 0.01 * rng.standard_normal((50, dim))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    return [(int(i), v.tolist(), int(k)) for i, v, k in zip(rng.permutation(n), x, rng.integers(0, 10, n), strict=True)]


def nearest(rows, every, k):
    found = {}
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], np.float32).astype(float)
    for i in range(len(rows)):
        if ids[i] % every == 0:
            scores = (x * x[i]).sum(axis=1)
            found[ids[i]] = sorted((-scores[j], ids[j]) for j in range(len(rows)) if j != i)[:k]
    return found


@pytest.mark.parametrize("scale", [1.0, 37.5])
def test_recall_and_scores(spark, scale):
    rows = [(i, [x * scale for x in v], k) for i, v, k in clustered(4000)]
    if scale != 1.0:  # inner products, not angles: lengths differ
        rng = np.random.default_rng(5)
        rows = [(i, (np.array(v) * rng.uniform(0.5, 1.5)).tolist(), k) for i, v, k in rows]
    df = table(spark, rows).repartition(5)
    out = neighbours.search(df, df.where("vec_id % 20 = 0"), per_bucket=64, sample=500).collect()
    exact = nearest(rows, 20, 20)
    mine = {}
    for r in out:
        mine.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    scores = {q: dict((v, -s) for s, v in nearest([r for r in rows], 20, len(rows))[q]) for q in list(exact)[:3]}
    for q, found in mine.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and len({f[1] for f in found}) == len(found) <= 20
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        for _, v, s in found if q in scores else []:
            assert math.isclose(scores[q][v], s, rel_tol=1e-12)
    hit = sum(len({v for _, v in exact[q]} & {v for _, v, _ in mine.get(q, [])}) for q in exact)
    # Copies tie: which ids come first is fixed, so that the sets may be compared.
    assert hit >= 0.9 * sum(map(len, exact.values()))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [], 1), (5, [nan, 1], 1), (6, [inf, 1], 1), (7, [None, 1], 1), (8, [0, 0], 1), (None, [1, 0], 1), (9, [0.25], 1), (20, [-1, 0], 0), (20, [-1, 0], 0), (1, [0.5, 0.5], 1)]
    df = table(spark, rows)
    found = [tuple(r) for r in neighbours.search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 9, 0.25), (0, 4, 20, -1.0), (20, 1, 9, -0.25), (20, 2, 1, -0.5), (20, 3, 2, -0.5), (20, 4, 0, -1.0)]
    empty = df.where("false")
    assert neighbours.search(empty, empty).collect() == [] == neighbours.search(df, empty).collect()
    lone = df.where("vec_id = 0")
    assert neighbours.search(lone, lone).collect() == []
    same_id = table(spark, [(0, [1, 0], 1), (0, [0, 1], 1)])  # each a query, and the other's answer
    assert sorted(tuple(r) for r in neighbours.search(same_id, same_id).collect()) == [(0, 1, 0, 0.0), (0, 1, 0, 0.0)]


def plain_negatives(rows, positives=5, negatives=3):
    """rows of (vec_id, vector, label) that take part."""
    v = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in rows]
    label = [(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in rows]
    out = set()
    for i, r in enumerate(rows):
        if r[0] % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v[i], v[j], strict=True)), rows[j][0], label[j] == label[i]) for j in range(len(rows)) if j != i)
        for p in [s for s in scored if s[2]][:positives]:
            ok = [s for s in scored if not s[2] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out |= {(r[0], p[1], rank, s[1], -p[0], -s[0]) for rank, s in enumerate(ok[:negatives], 1)}
    return out


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return [tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 50 == 0, label).collect()]


def test_hard_negatives_against_all_scores(spark):
    rows = clustered(900, copies=200)
    found = mined(table(spark, rows).repartition(7))
    assert len(found) == len(set(found)) > 100 and set(found) == plain_negatives(rows)


def test_hard_negatives_with_ties(spark):
    # Many rows share the k-th score, with ids far apart: the ids decide, digit by digit.
    rng = np.random.default_rng(1)
    rows = [(int(i), [1.0, 1.0] if j % 3 else [1.0, 0.7], j % 2) for j, i in enumerate(rng.choice(2**40, 300, replace=False))] + [(50, [1.0, 1.0], 0), (-100, [1.0, 0.9], 1)]
    assert set(mined(table(spark, rows))) == plain_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1, 0], 9), (1, [1, 0], 0), (2, [0.75, 0], 1), (3, [0.75, 0], 2), (4, [0.5, 0], 3), (5, [-1, 0], 4), (6, [0.96, 0], 5)]
    odd = [(8, None, 1), (9, [], 1), (10, [nan, 1], 1), (11, [inf, 1], 1), (12, [None, 1], 1), (None, [1, 0], 1), (13, [0.75, 0], None), (2, [0.75, 0], 1)]
    df = table(spark, good + odd)
    assert sorted(mined(df)) == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 49152), (0, 1, 3, 4, 65536, 32768)]
    assert mined(df.where("false")) == [] == mined(df.where("vec_id = 0"))
    huge = table(spark, [(0, [3e38, 1], 9), (1, [3e38, 1], 0), (2, [2e38, 0], 1)])  # scores end at 64 bits
    assert mined(huge) == []


def test_products():
    a, b = np.array([[2**40, 1], [3, -(2**62)]]), np.array([[2**40, 0], [1, 4]])
    assert products(a, b).tolist() == [[2**63 - 1, 2**40 + 4], [3 * 2**40, -(2**63)]]
    assert products(a[:, :1] % 7, b[:, 1:]).tolist() == [[0, 4 * (2**40 % 7)], [0, 12]]
