import random
import re

from orderdw.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(rows, items):
    """Every diagonal on which some mask fits, scored word by word."""
    out = {}
    for doc, text in rows:
        d = words(text)
        for item, held in items:
            b = words(held)
            for shift in range(-len(b), len(d)):
                pairs = [(b[k], d[k + shift]) for k in range(len(b)) if 0 <= k + shift < len(d)]
                same = [x == y for x, y in pairs]
                kind = max((least for least, _ in D.MASKS if len(b) >= least), default=0)
                if not any(all(same[k + i] for i, bit in enumerate(mask) if bit == "1")
                           for least, mask in D.MASKS if least == kind
                           for k in range(len(same) - len(mask) + 1)):
                    continue
                best = max(sum(1 if s else -2 for s in same[i:j])
                           for i in range(len(same) + 1) for j in range(i, len(same) + 1))
                if best >= min(12, -(-8 * len(b) // 10)) or sum(same) >= -(-8 * len(b) // 10):
                    new = (best, -shift, len(b), sum(same))
                    if doc is not None:
                        out[doc, item] = max(out.get((doc, item), new), new)
    return sorted((d, i, -s, n, m, b) for (d, i), (b, s, n, m) in out.items())


def test_like_brute_force(spark, docs_frame):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 9, 15, 30]))))
             for i in range(8)] + [(8, ""), (9, None)]
    rows = []
    for i in range(40):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if i % 2:
            part = words(items[rng.randrange(8)][1])
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                part[rng.randrange(len(part))] = "other"
            text[5:5] = part
        rows.append((i, "- " * (i % 3 == 0) + ", ".join(text).upper() + " !" * (i % 4)))
    rows += [(rows[1][0], rows[1][1]), (90, None), (91, ""), (None, items[2][1]), (92, items[3][1])]
    docs = docs_frame(rows).selectExpr("*", "1 AS at", "2 AS seed", "3 AS words", "4 AS item_id")
    tests = spark.createDataFrame([(*r, 0, 0) for r in items],
                                  "item_id long, text string, doc_id int, shift int")
    got = sorted(map(tuple, D.overlaps(docs, tests).collect()))
    assert got == brute(rows, items)
    assert got
    kept = D.without_leaks(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        d for d, _ in rows if d is not None and d not in {g[0] for g in got})
    assert D.overlaps(docs_frame([]), tests).count() == 0
    assert D.overlaps(docs, tests.limit(0)).count() == 0


def test_shuffled_join_gives_the_same(spark, docs_frame, monkeypatch):
    item = " ".join(f"t{i}" for i in range(20))
    docs = docs_frame([(1, "a b c " + item), (2, "a b c " * 10)])
    tests = spark.createDataFrame([(7, item)], "item_id long, text string")
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert [tuple(r) for r in D.overlaps(docs, tests).collect()] == [(1, 7, 3, 20, 20, 20)]


def test_planted_copies_with_changed_words(spark, docs_frame):
    """Copies of items of four to sixty words with up to a fifth of the words changed."""
    rng = random.Random(7)
    items, rows = [], []
    for n in [4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60] * 6:
        item = [f"i{len(items)}x{k}" for k in range(n)]
        items.append((len(items), " ".join(item)))
        for share in (0, 0.1, 0.2):
            copy = list(item)
            for at in rng.sample(range(n), int(share * n)):
                copy[at] = "changed"
            around = [f"w{rng.randrange(999)}" for _ in range(60)]
            rows.append((len(rows), " ".join(around[:30] + copy + around[30:])))
    clean = [(1000 + i, " ".join(f"w{rng.randrange(999)}" for _ in range(90))) for i in range(50)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.overlaps(docs_frame(rows + clean), tests).collect()}
    want = {(i, i // 3) for i, _ in rows}
    assert found <= want and len(found) >= 0.95 * len(want)
    for share in (0, 1, 2):  # unchanged, a tenth, a fifth
        asked = {w for w in want if w[0] % 3 == share}
        assert len(asked & found) >= 0.9 * len(asked)
    assert not {w for w in want if w[0] % 3 == 0} - found


def test_a_million_words_in_the_shuffled_form(spark, docs_frame, monkeypatch):
    item = " ".join(f"t{i}" for i in range(20))
    long = "a b c d e f g h i j " * 50_000 + item + " k l m n o p q r s t" * 50_000
    tests = spark.createDataFrame([(7, item), (8, "zz yy xx")], "item_id long, text string")
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    found = D.overlaps(docs_frame([(1, long), (2, "zz yy xx"), (2, "zz yy"), (3, "- zz yy xx")]), tests)
    assert sorted(map(tuple, found.collect())) == [(1, 7, 500_000, 20, 20, 20), (2, 8, 0, 3, 3, 3),
                                                   (3, 8, 0, 3, 3, 3)]


def test_no_python_in_the_plan(spark, docs_frame):
    tests = spark.createDataFrame([(7, "a b c d e f g h i j k l")], "item_id long, text string")
    plan = D.overlaps(docs_frame([(1, "a")]), tests)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
