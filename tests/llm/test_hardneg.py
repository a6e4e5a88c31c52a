"""Hard negatives against a plain search, with odd rows and small buckets."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int"


def plain(rows, every, positives, negatives):
    data = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, label, *_ in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, label, q) in enumerate(data):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, d[2])), d[0], d[1]) for b, d in enumerate(data) if b != a and len(d[2]) == len(q)]
        for score, p in sorted(s[:2] for s in scored if s[2] == label)[:positives]:
            near = sorted(s[:2] for s in scored if s[2] != label and -30 * score <= -100 * s[0] <= -90 * score)
            out += [(i, p, n + 1, x, -score, -s) for n, (s, x) in enumerate(near[:negatives])]
    return sorted(out)


def odd_rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    x = centres[rng.integers(0, 6, 300)] + 0.7 * rng.normal(size=(300, 8))
    x = np.round(x / np.linalg.norm(x, axis=1, keepdims=True) * rng.choice([0.5, 1, 1, 2], size=(300, 1)), 3).astype(np.float32)
    rows = [(i, [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [(500 + i, rows[7][1], 2) for i in range(60)]  # copies
    rows += [(5, rows[9][1], 1), (5, rows[10][1], 3), (10, rows[3][1], 0), (15, rows[15][1], rows[15][2])]  # repeated ids
    rows += [
        (None, rows[0][1], 1), (700, None, 1), (701, [1.0, None], 0), (702, [float("nan")] * 8, 1), (703, [0.0] * 8, 1), (704, [], 1),
        (705, [0.5, 0.5], 1), (710, [0.4, 0.2], 2), (711, [0.4, 0.9], 1), (715, rows[5][1], None), (725, [float("inf")] * 8, 1),
        (720, [3.0e12] + [0.0] * 7, 1), (721, [3e12, 1e12] + [0.0] * 6, 2), (722, [2e12, 1e12] + [0.0] * 6, 1),
    ]
    return [(*r, "x", None) for r in rows]


@pytest.mark.parametrize("bucket, part, block", [(2048, 16_384, 2048), (16, 64, 8), (5, 16, 3)])
def test_same_as_plain(spark, monkeypatch, bucket, part, block):
    for name, value in (("BUCKET", bucket), ("PART", part), ("BLOCK", block)):
        monkeypatch.setattr(hardneg, name, value)
    rows = odd_rows()
    got = hardneg.mine(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 5 == 0, positives=3, negatives=4)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 3, 4)


def test_without_rows(spark):
    assert hardneg.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 5 == 0).collect() == []
    assert hardneg.mine(spark.createDataFrame(odd_rows(), SCHEMA), F.lit(False)).collect() == []


def test_feasible_keeps_all_that_can_reach_the_floor():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 6):
        rows = np.floor(rng.normal(size=(400, dim)) * rng.choice([20, 60, 61], size=(400, 1)))
        bucket = hardneg._Bucket(np.arange(400), np.zeros(400), np.arange(400), rows)
        for _ in range(60):
            q = np.floor(rng.normal(size=dim) * 50)
            scores, floor = rows @ q, rng.uniform(0.2, 1.0) * float((rows @ q).max())
            focus = np.argsort(-np.abs(q))[: hardneg.FOCUS]
            kept = bucket.feasible(q, float(np.sqrt((q * q).sum())), focus, floor)
            assert set(np.flatnonzero(scores >= floor)) <= set(kept.tolist())


def test_coordinates_prune():
    """Rows round many centres: most are never verified."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = centres[rng.integers(0, 40, 2000)] + 0.1 * rng.normal(size=(2000, 16))
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1, keepdims=True))
    bucket = hardneg._Bucket(np.arange(2000), np.zeros(2000), np.arange(2000), rows)
    q = rows[0]
    kept = bucket.feasible(q, float(np.linalg.norm(q)), np.argsort(-np.abs(q))[: hardneg.FOCUS], 0.9 * float(q @ q))
    assert len(kept) < 500
