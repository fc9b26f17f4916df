import hashlib
import os
import random
import subprocess
import sys

import pytest

from orderdw.llm import sentencepiece_lattice as S

pytest.importorskip("sentencepiece")
CHARS = " aeiotnrsh.,\n▁éß日Ωx0()!'\t\U0001F600"
SHORT = ["", " ", "  a  b ", "the cat", "a\tb\nc", "É ß 日本 \U0001F600", "▁x ▁", "      x     y",
         "Don't (stop); 12,345 now...", " " * 40 + "end", "aaaaaaaaaaaaaaaaaaaa", "hello " * 30,
         "internationalization" * 30, "日" * 100, "tetethethe" * 2000]


def random_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(CHARS) for _ in range(rng.randint(1, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def unigram_model(tmp_path_factory):
    """The same pieces read as a unigram model, which only tests need."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(S.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -40000.0) / 1000 - 0.001 * len(p.piece) ** 2
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def library(path):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def test_words_are_cut_the_same_way_by_both_patterns():
    rng = random.Random(9)
    assert S.load_vocabulary().fine
    for _ in range(3000):
        unit = "".join(rng.choice("abé12._,\n日²½\u0301\u0930\u093f\U0001F600") for _ in range(8))
        cut = S.words_of(unit)
        assert "".join(cut) == S.SPACE + unit and cut == S._parts().findall(S.SPACE + unit)


def test_long_words_like_the_library():
    vocabulary, p = S.load_vocabulary(), library(S.MODEL)
    for text in SHORT + random_texts(300):
        got = [i for u in S.units_of(text) for w in vocabulary.words(u)
               for i in S.encode_long(vocabulary, w)]
        assert got == p.encode(text), text


def test_merges_like_the_library(spark, docs_frame):
    texts = SHORT + random_texts(400, 1)
    vocabulary, p = S.load_vocabulary(), library(S.MODEL)
    rows = list(enumerate(texts)) + [(5, texts[5]), (5000, None), (None, "no id")]
    docs = docs_frame(rows).selectExpr("*", "1 AS block", "2 AS ids", "3 AS word")
    for block_bytes in (1 << 25, 500):
        encoded = S.encode(docs, vocabulary, block_bytes)
        got = encoded.withColumn("back", S.decoded(encoded.ids, vocabulary)).collect()
        assert len(got) == len(rows)
        for r in got:
            text = {None: "no id", 5000: None}.get(r.doc_id, texts[(r.doc_id or 0) % 5000 % len(texts)])
            assert (r.ids, r.back) == ((p.encode(text), text.replace("▁", " ")) if text is not None
                                       else (None, None)), text
        checked = S.encode(docs, vocabulary, block_bytes, verify=True)
        back = sorted(((r.doc_id, r.text) for r in S.decode(checked, vocabulary).collect()), key=str)
        assert back == sorted(((r.doc_id, r.back) for r in got), key=str)
        for r in checked.collect():
            text = dict(rows).get(r.doc_id)
            if text is None:
                assert (r.decoded_sha256, r.round_trip) == (None, None)
            else:
                shown = hashlib.sha256(text.replace("▁", " ").encode()).hexdigest()
                assert (r.decoded_sha256, r.round_trip) == (shown, True), text
    assert S.encode(docs.limit(0), vocabulary, verify=True).count() == 0
    bad = spark.createDataFrame([(1, [vocabulary.first_byte + 0xC3]), (2, []), (3, None)],
                                "doc_id long, ids array<int>")
    assert sorted(map(tuple, S.decode(bad, vocabulary).collect())) == [(1, "\ufffd"), (2, ""), (3, None)]


def test_blocks_of_equal_content_are_told_apart(spark, docs_frame):
    rows = [(1, "the cat sat")] * 40
    got = S.encode(docs_frame(rows).repartition(8), verify=True).collect()
    want = library(S.MODEL).encode("the cat sat")
    assert len(got) == 40 and all(r.ids == want and r.round_trip for r in got)


def test_unigram_like_the_library(spark, docs_frame, unigram_model):
    vocabulary, p = S.load_vocabulary(unigram_model, "unigram"), library(unigram_model)
    texts = ["the cat sat", "Don't stop; now 日本", "internationalization", "x" * 100 + " y é"]
    got = {r.doc_id: r.ids for r in S.encode(docs_frame(enumerate(texts)), vocabulary).collect()}
    assert [got[i] for i in range(len(texts))] == [p.encode(t) for t in texts]


def test_documents_like_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    p = library(S.MODEL)
    got = S.encode(docs).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.ids == p.encode(r.text) for r in got)


def test_words_like_the_library(spark):
    """Words made of pieces, so that parts of a piece often form after the piece's own turn."""
    from pyspark.sql import functions as F
    rng = random.Random(3)
    vocabulary = S.load_vocabulary()
    letters = [p for p, _, _ in vocabulary.pieces if p.isalpha() and len(p) < 9]
    words = sorted({S.SPACE + "".join(rng.choice(letters) for _ in range(rng.randint(1, 4)))
                    for _ in range(4000)})
    words = [w for w in words if len(w) <= S.LONG_WORD]
    frame = spark.createDataFrame([(w,) for w in words], "word string").select(
        F.lit(1).cast("long").alias("bucket"), "word",
        F.array(F.struct(F.lit(1).cast("long").alias("block"), F.lit(1).alias("number"))).alias("asks"))
    got = {r.word: r.ids for r in S.encode_words(frame, vocabulary).collect()}
    p = library(S.MODEL)
    assert got == {w: p.encode(w[1:]) for w in words}


def test_a_block_holds_its_words_as_arrays():
    """A block of many words keeps no Python object for each of them, and asks for each once."""
    import pyarrow as pa

    from orderdw.llm.common import packed
    vocabulary = S.load_vocabulary()
    texts = [f"word{n} and word{n}, " + SHORT[n % len(SHORT)] for n in range(600)] + [None]
    rows = pa.RecordBatch.from_arrays([pa.array(range(601), pa.int64()), pa.array(texts)],
                                      ["doc_id", "text"])
    block = S._Block(pa.py_buffer(packed([rows.slice(0, 300), rows.slice(300)])), 7, vocabulary, 5, 2)
    assert isinstance(block.words, pa.StringArray)
    asked = [t.split(S.BETWEEN) for t in block.requests().to_pylist()]
    assert block.buckets.tolist() == [5, 6, 7, 8, 9]
    every = [w for words in asked for w in words]
    known = {w for t in texts if t for u in S.units_of(t) for w in vocabulary.words(u)}
    assert len(every) == len(set(every))
    assert {w for w in known if len(w) <= S.LONG_WORD} == set(every)
    found = [[S.encode_long(vocabulary, w) for w in words] for words in asked]
    answers = pa.array([{"bucket": b, "ids": sum(x, []), "sizes": [len(i) - 128 for i in x]}
                        for b, x in zip(block.buckets.tolist(), found)][::-1])
    got = [ids for _, part in block.encoded(vocabulary, answers) for ids in part.to_pylist()]
    p = library(S.MODEL)
    assert got == [None if t is None else p.encode(t) for t in texts]


def test_the_piece_table_starts_no_python_worker(spark):
    """Rows of Python objects would be unpickled by workers that then wait beside those of the texts."""
    vocabulary = S.load_vocabulary()
    frame = vocabulary.frame(spark)
    assert "Python" not in frame._jdf.queryExecution().toRdd().toDebugString()
    assert frame.dtypes == [("piece", "string"), ("id", "int"), ("rank", "int"), ("score", "double"),
                            ("late", "boolean")]
    rows = frame.collect()
    assert [(r.piece, r.id, r.score) for r in rows] == vocabulary.pieces
    assert all((r.rank, r.id) == vocabulary.ranks[r.piece] for r in rows)
    some = rows[::500]
    assert [r.late for r in some] == [vocabulary.late(r.piece) for r in some]
    nothing = S.Vocabulary("bpe", [], 0, 0, [])
    assert nothing.frame(spark).collect() == [] and nothing.frame(spark).dtypes == frame.dtypes


def test_edges_are_collected_as_numbers(spark):
    """A row for each edge of a word would take several times the room of a number."""
    from pyspark.sql import functions as F
    words = spark.range(1).select(F.col("id").alias("bucket"), F.lit("▁the").alias("word"), F.array(
        F.struct(F.col("id").alias("block"), F.lit(1).alias("number"))).alias("asks"))
    encoded = S.encode_words(words, S.load_vocabulary())
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    lattice = next(x for x in plan.splitlines() if "collect_list" in x)
    assert "struct" not in lattice
    assert encoded.first().ids == library(S.MODEL).encode("the")


ONE_WORKER = """
import random, re
from types import SimpleNamespace
import pyarrow as pa
from orderdw.llm import sentencepiece_lattice as S
from orderdw.llm.common import packed

def held():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Anonymous:\\s+(\\d+)", f.read())[1]) / 1024

rng = random.Random(4)
texts = [" ".join(f"{rng.choice('abcdef')}{rng.randrange(200000)}" for _ in range(500))
         for _ in range(2000)]
parts = [pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts[i:i + 200])],
                                    ["doc_id", "text"]) for i in range(0, 2000, 200)]
rows = pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([packed(parts)], pa.binary())],
                                  ["block", "texts"])
vocabulary = SimpleNamespace(value=S.load_vocabulary())
asks = S._requests(vocabulary, 64, 1)
first = pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([packed([parts[0].slice(0, 2)])],
                                   pa.binary())], ["block", "texts"])
list(asks(iter([first])))
pa.default_memory_pool().release_unused()
before = held()
for _ in asks(iter([rows] * 3)):
    pass
print(held() - before)
"""


def test_a_worker_gives_back_what_a_block_took():
    """Workers wait between blocks, stages and queries; what a block took is not held meanwhile."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(S.__file__)))
    done = subprocess.run([sys.executable, "-c", ONE_WORKER], capture_output=True, text=True,
                          cwd=root, timeout=120)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 40
