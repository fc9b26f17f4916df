import math
import random

import pytest

from orderdw.llm import quality as Q

GOOD = "Some words of a text that reads well, with commas and a full stop at the end."
BAD = "BUY!! NOW!! $$$ %%% BUY!! NOW!! $$$ %%%"


def rows(n=200):
    rng = random.Random(1)
    out = []
    for i in range(n):
        words = (GOOD if i % 3 else BAD).split()
        rng.shuffle(words)
        out.append((i, " ".join(words * rng.randint(1, 4)), "en", f"s{i % 4}", 1, 7, 8))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, _p int, quality int"


def test_judges(spark):
    odd = [(1000, None, None, None, 0, 0, 0), (1001, "", "en", "s1", 0, 0, 0), rows()[4],
           (None, GOOD, "en", "only", 0, 0, 0), (1002, "word " * 300_000, "xx", "s0", 0, 0, 0)]
    docs = spark.createDataFrame(rows() + odd, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)]
                                   + [(7, 1, 0), (None, 1, 0), (8, None, 0), (9999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = Q.judge(docs, labels).collect()
    assert len(got) == 205
    for r in got:
        assert 0 < r.score < 1
        if r.doc_id is not None and r.doc_id < 200:
            assert r.keep == (r.doc_id % 3 > 0)
    kept = Q.good_ones(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        r.doc_id for r in got if r.keep and r.doc_id is not None)


def test_without_labels_all_stay(spark):
    docs = spark.createDataFrame(rows(20), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.keep for r in Q.judge(docs, none).collect())
    assert Q.good_ones(docs, none).count() == 20
    assert Q.judge(docs.limit(0), none).count() == 0


def test_sparse_sites_shrink(spark):
    evidence = [("big", "en", 0.0)] * 300 + [("good", "en", 1.0)] * 300 + [
        (f"h{i}", "en", float(i % 2)) for i in range(40)] + [("tiny", "en", 0.0)]
    sites, overall = Q.site_posteriors(
        spark.createDataFrame(evidence, "host string, path string, good double"))
    rate = {r.host: r.path_rate for r in sites.collect()}
    assert overall == pytest.approx((320 + 1) / (641 + 2))
    assert rate["big"] < 0.05 and rate["good"] > 0.95
    assert 0.05 < rate["tiny"] < overall


def test_posteriors_by_hand(spark):
    evidence = [("a", "x", 1.0)] * 8 + [("a", "y", 0.0)] * 8 + [("b", "x", 1.0)] * 8
    sites, overall = Q.site_posteriors(
        spark.createDataFrame(evidence, "host string, path string, good double"))
    rows_ = {(r.host, r.path): r for r in sites.collect()}
    assert overall == pytest.approx(17 / 26)

    def strength(groups):
        n = sum(g[0] for g in groups)
        within = sum(g[0] * g[2] * (1 - g[2]) for g in groups)
        between = sum(g[0] * (g[1] - g[2]) ** 2 for g in groups)
        spread = max(0.0, (between - sum(g[2] * (1 - g[2]) for g in groups)) / n)
        return min(1e6, max(1.0, within / n / spread - 1)) if spread > 0 else 1e6
    k0 = strength([(16, .5, overall), (8, 1.0, overall)])
    hosts = {"a": (8 + k0 * overall) / (16 + k0), "b": (8 + k0 * overall) / (8 + k0)}
    k1 = strength([(8, 1.0, hosts["a"]), (8, 0.0, hosts["a"]), (8, 1.0, hosts["b"])])
    for (h, p), good in {("a", "x"): 8, ("a", "y"): 0, ("b", "x"): 8}.items():
        assert rows_[h, p].host_rate == pytest.approx(hosts[h])
        assert rows_[h, p].path_rate == pytest.approx((good + k1 * hosts[h]) / (8 + k1))
        assert not math.isnan(rows_[h, p].path_rate)


def test_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
                    for t in ("documents", "labels"))
    got = Q.judge(docs, labels.filter("doc_id % 2 = 0")).join(labels, "doc_id").filter(
        "doc_id % 2 = 1").selectExpr("avg(double(keep = (quality = 1))) AS right").first()
    assert got.right > 0.97
