"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdrift.llm import hard_negatives, op12_query
from holdrift.llm.hard_negatives import Mining

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, anchor, mining=Mining()):
    taken = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taken.append((vec_id, [math.floor(mining.scale * float(np.float32(x))) for x in vector], label))

    def best(found, size):
        return sorted(found, key=lambda p: (-p[0], p[1] is None, p[1] or 0))[:size]

    out = []
    for a, (anchor_id, mine, label) in enumerate(taken):
        if not anchor(anchor_id):
            continue
        scores = [(sum(x * y for x, y in zip(mine, theirs)), vec_id, other == label)
                  for b, (vec_id, theirs, other) in enumerate(taken) if b != a and len(theirs) == len(mine)]
        for p in best([s for s in scores if s[2]], mining.positives):
            inside = [s for s in scores if not s[2]
                      and mining.least_percent * p[0] <= 100 * s[0] <= mining.most_percent * p[0]]
            for rank, n in enumerate(best(inside, mining.negatives), 1):
                out.append((anchor_id, p[1], rank, n[1], p[0], n[0]))
    return sorted(out, key=str)


def mined(spark, rows, every=100, mining=Mining()):
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row_no", "'x' AS anchor", "2 AS norm", "3 AS cell")
    found = hard_negatives.mined(vectors, F.col("vec_id") % every == 0, mining)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int",
                                  "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(seed, n, length=16, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, length))
    rows = []
    for k in range(n):
        vector = centres[k % 6] * rng.uniform(0.3, 2) + rng.normal(size=length) * 0.4
        rows.append((k, [float(np.float32(x)) for x in vector], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("mining", [
    Mining(), Mining(references=3, sample=40, anchors_per_block=7, rows_per_group=50), Mining(references=0),
    Mining(scale=10, positives=2, negatives=3, least_percent=50, most_percent=100)])
def test_brute_force(spark, mining):
    rows = clustered(7, 400)
    rows += [(k + 1000, rows[k][1], 3) for k in range(60)] + [(2000 + k, rows[5][1], k % 4) for k in range(40)]
    random.Random(1).shuffle(rows)
    found = mined(spark, rows, 10, mining)
    assert found == brute_force(rows, lambda i: i % 10 == 0, mining) and len(found) > 100


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(3, 80, 8, 2)
    rows += [(100, None, 1), (200, rows[0][1], None), (300, [nan] * 8, 1), (400, [inf] + [0.0] * 7, 1),
             (500, [None] + [1.0] * 7, 0), (600, [], 1), (700, [0.0] * 8, 1), (800, [1.0, 2.0], 0), (801, [1.0, 2.0], 0),
             (802, [1.0, 1.0], 1), (None, rows[3][1], 0), (None, rows[3][1], 1), (10, rows[20][1], 0), (10, rows[20][1], 0),
             (900, [4e5] * 8, 0), (901, [4e5] * 8, 0), (902, [2e5] * 8, 1), (903, [-4e5] * 8, 0)]
    found = mined(spark, rows, 10)
    assert found == brute_force(rows, lambda i: i is not None and i % 10 == 0)
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [3e38] * 4, 1), (200, [1.0] * 4, 1)]) == []


def test_bounds_hold_for_extreme_angles():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 64))
    vectors = np.floor(256 * np.concatenate([base, base, -base, base * 100, base + 1e-3, np.zeros((1, 64))]))
    norms = np.linalg.norm(vectors, axis=1)
    references = vectors[:8] / norms[:8, None]
    rows = hard_negatives._Rows.__new__(hard_negatives._Rows)
    rows.vectors, rows.norms, rows.slack, rows.longest = vectors, norms, hard_negatives.slack(64), norms.max()
    rows.angles = hard_negatives._angles(vectors, norms, references).astype(np.float64)
    rows.numbers, rows.labels, rows.wanted, rows.length = np.arange(len(vectors)), norms, [None] * len(vectors), 64
    at = np.arange(len(vectors))
    pruned = 0
    for k in at:
        anchor = hard_negatives._Anchor(rows, k)
        scores = rows.scores(anchor, at)
        low, high = rows.bounds(anchor, at)
        assert (low <= scores).all() and (scores <= high).all()
        pruned += (high < 0.9 * norms[k] * norms).sum()
    assert pruned > 0


def test_query_on_hot_label(spark):
    rows = [(k, v, 1 if k % 3 else label) for k, v, label in clustered(11, 300, 8)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.mined(op12_query.relabelled(vectors), F.col("vec_id") % 100 == 0).collect()
    changed = [(k, v, (label + 1) % 10 if k % 7 == 0 else label) for k, v, label in rows]
    assert sorted(map(tuple, found), key=str) == brute_force(changed, lambda i: i % 100 == 0)
