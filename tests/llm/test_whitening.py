import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderdw.llm import embedding_whitening as W


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_secular_roots_against_a_dense_solver(n):
    rng = np.random.default_rng(n)
    d, z = np.sort(rng.random(n)) * 10, rng.normal(size=n)
    values, vectors = W.secular_roots(d, z)
    assert np.allclose(values, np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-13)
    assert np.allclose(vectors * values @ vectors.T, np.diag(d) + np.outer(z, z), atol=1e-12)


def _scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


@pytest.mark.parametrize("block", [1, 5, 300])
def test_spectrum_by_blocks_and_by_single_vectors(block):
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 50)
    x[20:60] = x[3]
    s = W.Spectrum(12)
    for lo in range(0, len(x), block):
        s.add_block(x[lo:lo + block])
    assert np.allclose(s.axes * s.values @ s.axes.T, _scatter(x), atol=1e-8)
    assert np.allclose(s.mean, x.mean(axis=0)) and s.n == 300


def test_spectra_with_equal_values_and_few_directions():
    x = np.zeros((9, 6))
    for i in range(4):
        x[2 * i, i], x[2 * i + 1, i] = 3, -3
    s, t = W.Spectrum(6), W.Spectrum(6)
    for row in x[:5]:
        s.add_block(row[None])
    for row in x[5:]:
        t.add_block(row[None])
    s.add_spectrum(t.n, t.mean, t.values, t.axes)
    assert np.allclose(s.axes * s.values @ s.axes.T, _scatter(x), atol=1e-10)
    assert np.allclose(s.axes.T @ s.axes, np.eye(s.axes.shape[1]), atol=1e-12)


def _brute(rows, components=8):
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in ok])
    n, s = len(x), x.sum(axis=0)
    c = x - x.mean(axis=0)
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return {"ids": [i for i, _ in ok], "n": n,
            "deviation": [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x],
            "white": c @ vectors / np.sqrt(np.maximum(values, 1e-300)),
            "share": values / np.trace(cov)}


def _frame(spark, rows, extra=""):
    return spark.createDataFrame([(i, v, *([7] if extra else [])) for i, v in rows],
                                 "vec_id long, embedding array<float>" + extra)


def _compare(found, rows, components=8):
    want = _brute(rows, components)
    assert sorted(r.vec_id for r in found) == sorted(want["ids"])
    by_id = {r.vec_id: r for r in found}
    got = np.array([by_id[i].whitened for i in want["ids"]])
    sign = np.sign((got * want["white"]).sum(axis=0))
    assert np.allclose(got, want["white"] * sign, atol=1e-9)
    for i, d in zip(want["ids"], want["deviation"]):
        r = by_id[i]
        assert (r.n, int(r.deviation)) == (want["n"], d) and r.identity_error < 1e-9
        assert np.allclose(r.explained, want["share"], rtol=1e-9)


@pytest.mark.parametrize("parts,rank", [(1, 128), (40, 128), (5, 10)])
def test_whitening_against_brute_force(spark, parts, rank):
    rng = random.Random(parts)
    spread = [rng.uniform(0.05, 1) for _ in range(24)]
    rows = [(i, [float(np.float32(rng.gauss(0, s))) for s in spread]) for i in range(400)]
    rows += [(500, None), (501, []), (502, [None] * 24), (503, [float("nan")] * 24),
             (504, [float("inf")] + [0.0] * 23)]
    docs = _frame(spark, rows, ", n int").repartition(parts)
    _compare(W.whiten(docs, rank=rank, block_rows=64).collect(), rows)


def test_lengths_repeats_and_vectors_without_variance(spark):
    short = [(i, [float(i % 5), float(i * i % 7), 1.0]) for i in range(30)]
    equal = [(100 + i, [0.5, 0.25]) for i in range(4)]
    single = [(200, [1.0, 2.0, 3.0, 4.0])]
    rows = W.whiten(_frame(spark, short + equal + single + [(None, [1.0, 2.0, 1.0])])).collect()
    assert len(rows) == 36
    by_id = {r.vec_id: r for r in rows}
    assert by_id[100].whitened == [None, None] and by_id[100].deviation == 0
    assert by_id[100].explained == [0.0, 0.0] and by_id[100].identity_error == 0.0
    assert by_id[200].n == 1 and by_id[0].n == 31 and None in by_id
    assert by_id[0].whitened[2] is None and len(by_id[0].whitened) == 3
    twice = W.whiten(_frame(spark, short + short)).collect()
    assert len(twice) == 60 and {r.n for r in twice} == {60}


def test_empty_table_and_large_numbers(spark):
    empty = W.whiten(_frame(spark, [(1, None)]))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"
    with pytest.raises(Exception, match="2\\^40"):
        W.whiten(_frame(spark, [(1, [1e30, 0.0])])).collect()
    far = [(i, [1e5 * (i % 3), 1.0 * (i % 2)]) for i in range(50)]
    _compare(W.whiten(_frame(spark, far)).collect(), far, 2)


def test_query_on_test_data(spark):
    folder = "/root/testdata/sf0.001"
    rows = W.op11_secular_whitening(spark, folder)
    found = (rows.groupBy("vec_id").agg(F.max("n").alias("n"), F.max("deviation").alias("deviation"),
             F.max("identity_error").alias("identity_error"),
             F.transform(F.array_sort(F.collect_list(F.struct("component", "whitened"))),
                         lambda x: x["whitened"]).alias("whitened"),
             F.transform(F.array_sort(F.collect_list(F.struct("component", "explained"))),
                         lambda x: x["explained"]).alias("explained")).collect())
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    _compare(found, [(r.vec_id, r.embedding) for r in vectors])
