import random

import pytest

from orderdw.llm import line_dedup as L


def brute(rows, min_points=20, min_docs=3):
    def key(line):
        s = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    holders = {}
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_points:
                    holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        kept = [x for x in (text or "").split("\n")
                if doc is None or len(holders.get(key(x), ())) < min_docs
                or doc == max(holders[key(x)])]
        out.append((doc, "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_lines_like_brute_force(spark, docs_frame, parts):
    rng = random.Random(int(parts))
    pool = [f"Line number {i} is long enough É" for i in range(6)] + ["short", "", "  "]
    rows = [(i, "\n".join(rng.choice(pool).upper() if rng.random() < .2 else
                          rng.choice([" ", ""]) + rng.choice(pool) + rng.choice(["\t\r", ""])
                          for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(7, rows[7][1]), (8, "another text\n" + pool[0]), (None, pool[0]), (60, None), (61, ""),
             (62, pool[0] + "\n" + "x" * 500_000)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = L.without_repeats(docs_frame(rows))
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted([(r.doc_id, r.text or "") for r in got.collect()], key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_and_clashing_columns(spark, docs_frame):
    assert L.without_repeats(docs_frame([])).count() == 0
    odd = docs_frame([(i, "the same line in all of them") for i in range(4)]).selectExpr(
        "*", "1 AS at", "2 AS tid", "3 AS n_dropped", "4 AS k1")
    got = L.without_repeats(odd)
    assert got.columns == odd.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == ["", "", ""] + [
        "the same line in all of them"]
