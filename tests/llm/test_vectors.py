"""Top-k search and embedding near-dedup against brute force, with odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import embdedup, topk

SCHEMA = "vec_id long, embedding array<float>, vec string, id int"


def vectors(seed, n, dim=8, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    return np.round(rows / np.linalg.norm(rows, axis=1, keepdims=True), 3).astype(np.float32)


def odd_rows(seed):
    rows = [(i, [float(x) for x in v], "x", i) for i, v in enumerate(vectors(seed, 260))]
    rows += [(1000 + i, rows[i][1], None, 0) for i in range(30)]  # copies
    rows += [
        (2000, None, "", 0), (2001, [1.0, None], "", 0), (2002, [float("nan")] * 8, "", 0), (2003, [float("inf")] + [0.0] * 7, "", 0),
        (2004, [0.0] * 8, "", 0), (2005, [], "", 0), (2006, [0.5, 0.5], "", 0), (2007, [0.4, 0.6], "", 0), (None, [1.0] * 8, "", 0),
        (2050, [3.0e5] + [0.0] * 7, "", 0),
    ]
    return rows


def usable(v, zero=True):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def plain_topk(rows, every, k):
    data = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    out = []
    for q, a in data:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in data if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("task_rows, task_queries, cell", [(1 << 17, 8192, 512), (50, 4, 8)])
def test_topk(spark, monkeypatch, task_rows, task_queries, cell):
    monkeypatch.setattr(topk, "TASK_ROWS", task_rows)
    monkeypatch.setattr(topk, "TASK_QUERIES", task_queries)
    monkeypatch.setattr(topk, "CELL_QUERIES", cell)
    rows = odd_rows(task_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = topk.nearest(df, F.col("vec_id") % 5 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == plain_topk(rows, 5, 3)


def test_topk_without_rows(spark):
    df = spark.createDataFrame(odd_rows(1), SCHEMA)
    assert topk.nearest(df.limit(0), F.lit(True)).count() == 0
    assert topk.nearest(df, F.lit(False)).count() == 0


def test_ties_go_to_smaller_ids(spark):
    df = spark.createDataFrame([(i, [0.5, 0.5], "", 0) for i in range(20)], SCHEMA)
    got = topk.nearest(df, F.col("vec_id") == 3, k=4).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 0), (2, 1), (3, 2), (4, 4)]


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 5.0], [2.0**20, 1.0]])
    assert topk._products(a, b).tolist() == [[2**63 - 1, 2**60 + 3]]


def plain_links(rows, cosine):
    data = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and usable(v, False) and len(v)]
    units = [(i, v / np.abs(v).max()) for i, v in data]
    units = [(i, v / np.linalg.norm(v)) for i, v in units]
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(units):
        for j, b in units[n + 1 :]:
            if len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(
        ((i, links[i], find(i), i == find(i)) if i is not None else (None, 0, None, False) for i, *_ in rows), key=repr
    )


@pytest.mark.parametrize("cell_rows, visit_rows, tile", [(1 << 14, 1 << 17, 1024), (16, 40, 1024)])
def test_embedding_dedup(spark, monkeypatch, cell_rows, visit_rows, tile):
    monkeypatch.setattr(embdedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embdedup, "VISIT_ROWS", visit_rows)
    rows = odd_rows(7)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = embdedup.near_vectors(df, cosine=0.9)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_links(rows, 0.9)
    assert embdedup.near_vectors(df.limit(0)).count() == 0


def test_a_group_of_near_copies_is_one_component(spark):
    base = np.ones(16)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in base + 0.02 * rng.normal(size=16)], "", 0) for i in range(300)]
    got = embdedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}
