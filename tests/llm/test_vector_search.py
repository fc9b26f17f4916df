import math
import random

import numpy as np
import pytest

from orderdw.llm import vector_search as V


def brute(rows, asked, k):
    valid = {i: [math.floor(1024 * x) for x in v] for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in asked:
        scored = sorted((-sum(a * b for a, b in zip(valid[q], v, strict=True)), i)
                        for i, v in valid.items() if i != q and len(v) == len(valid[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK_ROWS", block)
    monkeypatch.setattr(V, "BLOCK_QUERIES", 3)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)]
    same = rows[4][1]
    rows += [(200 + i, same) for i in range(40)]
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [math.nan] * 8),
             (304, [math.inf] + [0.0] * 7), (305, [1.0, 2.0]), (306, [3.0, 4.0]),
             (None, same), (307, [0.0] * 8), (308, [1e5] * 8)]
    df = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows],
                               "vec_id long, embedding array<double>, slice int, rank int, dim int")
    asked = [0, 4, 50, 200, 239, 300, 303, 305, 307, 308]
    got = V.top_k(df, df.filter(df.vec_id.isin(asked)), k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, [a for a in asked if a not in (300, 303)], 5)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, V.top_k(df, df).collect())) == [(1, 1, 2, 2048 * 1024),
                                                             (2, 1, 1, 2048 * 1024)]
    assert V.top_k(df.limit(0), df.limit(0)).count() == 0


def test_queries_are_not_repeated_for_every_slice_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 10)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = V.top_k(df, df.filter("vec_id < 50"), k=3)
    assert len(got.collect()) == 150
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("size", [1.0, 30.0, 1e6, 1e14])
def test_bounds_hold_whatever_the_components(size):
    rng = np.random.default_rng(3)
    values = (rng.normal(0, 1, (400, 5)) * 1024 * size).astype(np.int64)
    values[200:220] = values[7]
    block = V.approximated(np.arange(400), values, 10, V.CELLS)
    queries = values[::40]
    middles, slack = V._middles(queries, block)
    exact = queries.astype(object) @ block.values.astype(object).T
    assert (np.abs(exact.astype(float) - middles) <= slack[:, None]).all()
    assert sum(block.copies) == len(block.ids) == 379 + 11
    assert (V._vectors(V._bytes(values), 5, 400) == values).all()
