import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from orderdw.llm import prefix_free as P


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(t), sum(gone), spans, kept, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def sample(seed, n=40, size=400):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdefgé')}{rng.randrange(40)}" for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 90))) for _ in range(5)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, size // 4)))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            lo, at = rng.randint(0, 30), rng.randint(0, len(text))
            text = text[:at] + p[lo:rng.randint(lo, len(p))] + text[at:]
        rows.append((i, text))
    rows += [(3, rows[3][1]), (100, None), (101, ""), (None, rows[5][1][:150]), (102, "a" * 700),
             (103, "ab" * 350), (104, "x" + "a" * 230), (105, "abcdefghijklm" * 40),
             (106, rows[7][1] + "\n" + rows[8][1]), (107, "y" * 250), (108, "é日" * 130)]
    return rows


@pytest.mark.parametrize("length, density, grid, block", [
    (200, 20, 50, 1 << 23), (200, 20, 50, 3000), (60, 8, 7, 2000), (40, 4, 39, 1 << 20),
    (200, 1000, 50, 1 << 20)])
def test_like_brute_force(spark, docs_frame, monkeypatch, length, density, grid, block):
    monkeypatch.setattr(P, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(P, "SORT_BYTES", 900)
    rows = sample(length + density)
    docs = docs_frame(rows).selectExpr("*", "1 AS block", "2 AS at", "3 AS key", "4 AS n_spans")
    got = P.without_repeats(docs, length, density, grid, block).collect()
    assert sorted([(*r[:4], bytes(r.kept), r.kept_sha256) for r in got], key=str) == brute(rows, length)


def test_empty_table(spark, docs_frame):
    assert P.without_repeats(docs_frame([])).count() == 0


def test_suffix_ranks():
    data = np.frombuffer(b"banana bandana banana", np.uint8)
    for length in (8, 11, 16):
        ranks = P.suffix_ranks(data, length)
        cut = [bytes(data[i:i + length]) for i in range(len(data))]
        order = {s: n for n, s in enumerate(sorted(set(c.ljust(length, b"\0") for c in cut)), 1)}
        assert ranks.tolist() == [order[c.ljust(length, b"\0")] for c in cut]
