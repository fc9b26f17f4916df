import math
import zlib
from collections import Counter

import numpy as np
import pytest

from orderdw.llm import language_ppm as P

TEXTS = {"a": ["the cat sat on the mat, and the dog sat too", "then the man ran to the hat"],
         "b": ["der hund und die katze", "und dann der mann, der über die straße geht"]}


def plain_bits(training, text):
    """Method C escapes over contexts of three bytes or less, one byte at a time."""
    tree = [Counter() for _ in range(4)]
    for t in training:
        b = P.PAD + t.encode()
        for i in range(3, len(b)):
            for order in range(4):
                tree[order][b[i - order:i + 1]] += 1
    total = 0.0
    b = P.PAD + text.encode()
    for i in range(3, len(b)):
        for order in (3, 2, 1, 0):
            context = b[i - order:i]
            seen = {g: c for g, c in tree[order].items() if g[:-1] == context}
            n, kinds = sum(seen.values()), len(seen)
            hit = seen.get(b[i - order:i + 1])
            if hit:
                total -= math.log2(hit / (n + kinds))
                break
            if n:
                total -= math.log2(kinds / (n + kinds))
        else:
            total += 8
    return total


def counts():
    out = Counter()
    for lang, texts in TEXTS.items():
        for t in texts:
            b = P.PAD + t.encode()
            for i in range(3, len(b)):
                out[lang, int.from_bytes(b[i - 3:i + 1], "big")] += 1
    return [(lang, g, n) for (lang, g), n in out.items()]


@pytest.mark.parametrize("piece", [1 << 20, 5])
def test_code_lengths(monkeypatch, piece):
    monkeypatch.setattr(P, "PIECE", piece)
    texts = ["the cat", "der Hund qxz", "x", "日本", "", "and und and und " * 5]
    got = P.Trees(counts()).code_lengths([t.encode() for t in texts])
    want = [[plain_bits(TEXTS[lang], t) for lang in "ab"] for t in texts]
    assert np.allclose(got, want, rtol=1e-4)


def test_frame(spark, docs_frame):
    rows = [(i, TEXTS["ab"[i % 2]][i // 2 % 2]) for i in range(40)]
    docs = docs_frame(rows).selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'a', 'b') AS lang",
                                       "1 AS gram", "2 AS docs", "3 AS held_out", "4 AS score")
    odd = docs_frame([(100, None), (101, ""), (102, "12 !?"), (None, TEXTS["b"][0]),
                      (104, "the cat " * 100_000)], lang=None).selectExpr(
        "doc_id", "text", "lang", "1 AS gram", "2 AS docs", "3 AS held_out", "4 AS score")
    got = P.identify(docs.unionByName(odd)).collect()
    assert len(got) == 45
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        want = {None: "b", 100: "und", 101: "und", 102: "und", 104: "a"}
        assert r.lang_pred == want.get(r.doc_id, "ab"[(r.doc_id or 0) % 2])
    nothing = P.identify(docs_frame([(1, "abc")], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert P.identify(docs_frame([])).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = (P.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
             .selectExpr("avg(double(lang_pred = lang)) AS share").first().share)
    assert right > 0.97
