import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from orderdw.llm import token_alignment as A

TOKENIZERS = "/opt/tokenizers"


@pytest.mark.parametrize("seed", range(5))
def test_gallop_is_a_lower_bound(seed):
    rng = np.random.default_rng(seed)
    among = np.unique(rng.integers(0, 500, 80))
    wanted = np.sort(rng.integers(-5, 510, 60))
    start = rng.integers(0, len(among), 60)
    assert (A.gallop(wanted, among, start) == np.searchsorted(among, wanted)).all()


def test_common_ends_of_rows_of_any_length():
    rng = random.Random(3)
    a, b = [], []
    for _ in range(60):
        last = rng.randint(1, 90)
        for side in (a, b):
            side.append(sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last}
                               if rng.random() < 0.9 else set()))
    cuts = [np.cumsum([0, *map(len, side)]) for side in (a, b)]
    row, in_a, in_b = A.common_ends(np.array(sum(a, []), np.int64), cuts[0],
                                    np.array(sum(b, []), np.int64), cuts[1])
    got = [(r, i - cuts[0][r], j - cuts[1][r]) for r, i, j in zip(row, in_a, in_b)]
    assert got == [(r, x.index(e), y.index(e)) for r, (x, y) in enumerate(zip(a, b))
                   for e in sorted(set(x) & set(y))]


def _brute(texts):
    """By the tokenizers' own library for the json file, with dictionaries of offsets."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    byte_of, rows, links = A._byte_of(), [], Counter()
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        data = ([bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids[0]],
                [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
                 b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
        if not text or any(b"".join(d) != (" " + text).encode() for d in data):
            rows.append((0, 0, [], ""))
            continue
        ends = [dict(zip(np.cumsum(list(map(len, d))).tolist(), range(len(d)))) for d in data]
        groups, own, at = [], [], (0, 0)
        for e in sorted(set(ends[0]) & set(ends[1])):
            to = ends[0][e] + 1, ends[1][e] + 1
            groups.append("|".join(",".join(map(str, ids[s][at[s]:to[s]])) for s in (0, 1)))
            own.append((ids[0][to[0] - 1], ids[1][to[1] - 1]))
            at = to
        rows.append((len(ids[0]), len(ids[1]), own,
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.update(own)
    best = Counter()
    for (_, i), n in links.items():
        best[i] = max(best[i], n)
    return [(n_a, n_b, len(own), len(own), sum(links[x] == best[x[1]] for x in own),
             sum(links[x] for x in own), digest) for n_a, n_b, own, digest in rows]


def _found(docs, **options):
    models = A.load_models()
    rows = A.link_summary(A.alignments(docs, models), models, **options)
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                        r.groups_sha256)) for r in rows.collect()]


def test_odd_texts_against_both_libraries(spark, docs_frame):
    rng = random.Random(1)
    marks = ["▁", "\x00", "\n\n", "\t", "  ", "é", "é", "中文", "\U0001f600",
             "<|endoftext|>", "<s>", "<0x41>", "ﬁ", " ", "123456", "don't", "　", "..."]
    texts = [None, "", " ", "  ", "\n", "a", *marks]
    texts += ["".join(rng.choice([*marks, " the", " word", "ing ", "x"]) for _ in range(rng.randint(1, 40)))
              for _ in range(150)]
    texts += ["lorem ipsum " * 20_000, "x" * 5000]
    texts += texts[:40]
    docs = docs_frame(list(enumerate(texts)))
    assert sorted(_found(docs)) == list(enumerate(_brute(texts)))
    assert sorted(_found(docs.repartition(5), block_links=300)) == list(enumerate(_brute(texts)))


def test_groups_cover_both_sides(spark, docs_frame):
    text = "Galloping searches, naïvely: 3.14 — done."
    r = A.alignments(docs_frame([(1, text), (None, text)])).collect()
    assert r[0][1:] == r[1][1:] and r[1].doc_id is None
    t = A.Tokenizers(A.load_models())
    at = (0, 0)
    for to in zip(r[0].a_ends, r[0].b_ends):
        sides = [b"".join(x[i].as_py() for i in ids[lo:hi]) for x, ids, lo, hi in zip(
            (t.a_bytes, t.b_bytes), (r[0].a_ids, r[0].b_ids), at, to)]
        assert sides[0] == sides[1]
        at = to
    assert at == (len(r[0].a_ids), len(r[0].b_ids))


def test_empty_table_and_rows_without_text(spark, docs_frame):
    empty = spark.createDataFrame([], "doc_id long, text string, links long, block long")
    assert _found(empty) == []
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert sorted(_found(docs_frame([(1, None), (2, "")]))) == [(1, zeros), (2, zeros)]


def test_query_on_test_data(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((d.doc_id for d in docs), _brute([d.text for d in docs])))
    got = {r.doc_id: tuple(r)[1:] for r in A.op12_gallop_align(spark, folder).collect()}
    assert got == want


def test_functions_before_a_bucketed_write_get_small_batches(spark):
    """Rows of lists are large: a batch of the usual 10,000 takes more room than the function."""
    import pyarrow as pa

    from orderdw.llm import common

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [batch.num_rows] * batch.num_rows, pa.int64())], ["block", "n"])

    before = spark.conf.get(common.BATCH_ROWS)
    rows = spark.range(0, 3000, 1, 1)
    got = common.bucketed(rows.mapInArrow(sizes, "block long, n long"), "block", "sizes")
    assert got.count() == 3000 and got.agg({"n": "max"}).first()[0] <= common.ROWS_PER_BATCH
    assert spark.conf.get(common.BATCH_ROWS) == before
