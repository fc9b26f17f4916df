import random

import pytest

from orderdw.llm import toxicity as T


@pytest.mark.parametrize("text,folded", [
    (None, " "), ("", " "), (" \n!! 12 ", "  "), ("Hello, World", " heiio worid "),
    ("1D10T", " idiot "), ("stуpid 5tup1d stup!d", " stypid stupid stupid "),
    ("аео", " aeo "), ("Idiöt", " idiot "), ("lo​ser", " ioser "),
    ("really?! no!", " reaiiy no "), ("in 2019 3 men", " in men ")])
def test_folding(text, folded):
    assert T.fold(text) == folded


def test_hits_weights_and_exceptions():
    lexicon = T.Lexicon({" clown ": 2.0, " clow": 1.0, " scum": 3.0},
                        frozenset({" clown fish ", " pond scum "}), name="t")
    lexicon = T.Lexicon({T.fold(k).rstrip() + " " * k.endswith(" "): v
                         for k, v in lexicon.weights.items()},
                        frozenset(T.fold(p) for p in lexicon.exceptions), name="t")
    m = T.Matcher(lexicon)
    def total(text):
        return sorted(m.hits(T.fold(text)).values())
    assert total("A clown and clowns") == [1.0, 2.0]
    assert total("a clown fish, pond scum") == []
    assert total("clown clown fish scumbag c10wn") == [2.0, 2.0, 3.0]
    assert total("uncIown") == [] and total("") == []
    assert len(total("clown " * 50_000)) == 50_000


def _texts(rng, n, start):
    rows = []
    for i in range(start, start + n):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.randrange(50)}x"
                 for _ in range(rng.randint(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            words[3:3] = [rng.choice(["zorgel", "Z0rgel", "zorgеl", "vrakken", "vrakkest"])]
        elif i % 16 == 1:
            words[5:5] = ["zorgel", "park"]  # a clean phrase
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_words_beginnings_and_exceptions(spark, docs_frame):
    rng = random.Random(4)
    rows = _texts(rng, 400, 0)
    copied = (1000, "odd quirky wording that was copied " * 3, 1)
    rows += [(1000 + i, copied[1], 1) for i in range(30)]
    docs = docs_frame([r[:2] for r in rows])
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(0, 1, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    lexicon = T.train(docs, labels)
    assert T.fold("zorgel park") in lexicon.exceptions
    assert any(e.startswith(" vrak") for e in lexicon.weights)
    assert not any("quirky" in e for e in lexicon.weights)  # copies count once
    held = _texts(rng, 200, 5000) + [(1, None, 0), (1, "", 0), (None, "vrakken", 1)]
    found = T.score(docs_frame([r[:2] for r in held]), lexicon).collect()
    assert len(found) == len(held)
    want = {i: t for i, _, t in held[:200]}
    assert sum((r.score >= 0.5) == bool(want[r.doc_id]) for r in found if r.doc_id in want) >= 196
    low = [r.score for r in found if r.doc_id == 1]
    assert len(low) == 2 and low[0] == low[1] < 0.5
    assert all(r.score >= 0.5 for r in found if r.doc_id is None)


def test_without_labels_and_empty_tables(spark, docs_frame):
    docs = docs_frame([(1, "some text"), (1, "some text")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = T.train(docs, none)
    assert [r.score for r in T.score(docs, lexicon).collect()] == [0.0, 0.0]
    one_kind = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert T.train(docs, one_kind).weights == {}
    assert T.score(docs_frame([]), lexicon).count() == 0


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in T.op13_toxic_lexicon(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").dropna().collect()
    held = [r for r in labels if found[r.doc_id].held_out]
    assert len(found) == 1000 and len(held) > 50
    right = sum(found[r.doc_id].predicted == r.toxic for r in held)
    assert right >= 0.95 * len(held)
    assert all(found[r.doc_id].predicted == 0 for r in held if r.toxic == 0)
