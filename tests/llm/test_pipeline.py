import random

import corpus_pipeline as C


def test_stages_on_planted_documents(spark, tmp_path):
    rng = random.Random(2)

    def words(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    shared = "This very line stands in many of the documents."
    item = " ".join(words(30))
    clean = {i: " ".join(words(rng.randint(80, 200))) for i in range(40)}
    docs = dict(clean)
    for i in (3, 5, 7, 9):
        docs[i] += "\n" + shared
    docs[50] = docs[10]  # exact copy
    near = docs[11].split(" ")
    near[50] = "changed"
    docs[51] = " ".join(near)
    docs[52] = " ".join(words(60)) + " " + item + " " + " ".join(words(60))
    for i in range(60, 80):
        docs[i] = " ".join(["BUY!! $$$ NOW!! %%%"] * rng.randint(5, 30))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in docs.items()]
    rows += [(90, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in docs if i % 2 == 0],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    folder = str(tmp_path)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = now.columns, {}
    for n, (name, stage) in enumerate(C.STAGES):
        now = stage(spark, now, folder)
        now.write.parquet(f"{folder}/out{n}")
        now = spark.read.parquet(f"{folder}/out{n}")
        seen[name] = {r.doc_id: r for r in now.collect()}
        assert name == "token_ids" or now.columns == columns
    assert set(clean) | {50, 51, 52} <= set(seen["quality"]) <= set(clean) | {50, 51, 52, 90}
    cut = {i: r.text for i, r in seen["line_dedup"].items()}
    assert [i for i in (3, 5, 7, 9) if shared in cut[i]] == [9]
    assert all(seen["line_dedup"][i].n_chars == len(cut[i]) for i in clean)
    assert set(seen["near_duplicates"]) & (set(clean) | {50, 51, 52}) == set(clean) | {52}
    assert set(seen["decontamination"]) & set(docs) == set(clean)
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    assert all(seen["token_ids"][i].ids == p.encode(cut[i]) for i in clean)
    whole = {r.doc_id: r.ids for r in C.run(spark, folder).collect()}
    assert whole == {i: r.ids for i, r in seen["token_ids"].items()}
