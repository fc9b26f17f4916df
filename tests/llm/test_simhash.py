import random

import pytest
import xxhash

from orderdw.llm import simhash_pivots as S


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "one", "A b C d", "a b c d e", "É é\x0b x\ty  z\n w a",
                                  "the cat sat on the mat " * 50, "x" * 100_000])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("slice_rows", [2048, 5])
def test_links_like_brute_force(spark, slice_rows):
    rng = random.Random(slice_rows)
    centres = [rng.getrandbits(64) for _ in range(8)] + [0]
    prints = {c for c in centres}
    for c in centres:
        for _ in range(25):
            f = c
            for _ in range(rng.randint(1, 7)):
                f ^= 1 << rng.randrange(64)
            prints.add(f)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i)
                                   for i, f in enumerate(prints)], "fp long, doc_id long")
    got = S.links(nodes, slice_rows=slice_rows).collect()
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for r in got:
        assert (prints[r.a] ^ prints[r.b]).bit_count() <= 4
        parent[find(r.a)] = find(r.b)
    want = classes(prints)
    mine = [find(i) for i in range(len(prints))]
    assert len(set(mine)) == len(set(want)) == len(set(zip(mine, want, strict=True)))


def test_components(spark, docs_frame):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(200)] for _ in range(6)]
    rows = []
    for i in range(60):
        text = list(base[i % 6])
        if i % 4:
            text[rng.randrange(200)] = "changed"
        rows.append((i, " ".join(text)))
    rows += [(100, None), (101, ""), (102, " \n"), (5, rows[5][1]), (None, rows[0][1])]
    docs = docs_frame(rows).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS table")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = classes(prints)
    lowest = {g: min(d for (d, _), h in zip(rows, groups, strict=True) if h == g and d is not None)
              for g in set(groups)}
    want = sorted((str(d), p, lowest[g]) for (d, _), p, g in zip(rows, prints, groups, strict=True))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(lowest.values()) | {None}
    assert S.near_duplicates(docs_frame([])).count() == 0


def test_one_of_each_tells_texts_of_one_id_apart(spark, docs_frame):
    rng = random.Random(9)

    def text():
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(120))

    a, b, c, d = text(), text(), text(), text()
    docs = docs_frame([(1, a), (2, a), (2, b), (3, c), (3, c), (4, c), (None, a), (5, d), (5, d + " x")])
    kept = sorted(((r.doc_id, r.text) for r in S.one_of_each(docs).collect()), key=str)
    five = [k for k in kept if k[0] == 5]
    assert len(five) == 1 and five[0][1] in (d, d + " x")
    assert [k for k in kept if k[0] != 5] == sorted(
        [(1, a), (2, b), (3, c), (3, c), (None, a)], key=str)
