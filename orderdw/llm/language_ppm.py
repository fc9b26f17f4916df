"""Language identification by prediction by partial matching (operator 3).

For each language a context tree of up to three bytes predicts the next byte, with escape
probabilities (method C) to the next shorter context and at last to 256 equal bytes. The trees are
learned once from a bounded sample and then frozen, so a text's code length under a language is a
sum of table entries and does not depend on the order in which texts are read. The language with the
shortest code wins. Trees of all languages share one index, so a byte costs two lookups in dense
tables and one row of costs; this runs in numpy over pieces of a megabyte, whatever the text's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import table

TRAIN_DOCS = 400  # about so many labelled documents are read for each language
HASH_STEPS = 1 << 30
PAD, PIECE = b"\n\n\n", 1 << 20


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): runs of four bytes in the texts of each batch."""
    for batch in batches:
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            b = np.frombuffer(PAD + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
            by_lang.setdefault(lang, []).append(
                (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
        for lang, parts in by_lang.items():
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()),
                 pa.array(n, pa.int64())], ["lang", "gram", "n"])


def gram_counts(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Counts of four-byte runs per language over a sample of ``labelled`` (doc_id, lang, text):
    the documents whose hash lies in a share that leaves about ``train_docs`` for each language."""
    sizes = labelled.groupBy("lang").count().collect()  # one row for each language to learn
    shares = {r["lang"]: min(1.0, train_docs / r["count"]) for r in sizes}
    if not shares:
        return labelled.sparkSession.createDataFrame([], "lang string, gram long, n long")
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    picked = labelled.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(HASH_STEPS))
                             < share * HASH_STEPS).select("lang", "text")
    return (picked.mapInArrow(_grams, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Trees:
    """Frozen context trees of all languages, as tables of code lengths in bits."""

    def __init__(self, counts: list[tuple[str, int, int]]) -> None:
        self.langs = sorted({c[0] for c in counts})
        codes = np.array([c[1] for c in counts], np.int64)
        number = {name: i for i, name in enumerate(self.langs)}
        lang = np.array([number[c[0]] for c in counts], np.int64)
        n = np.array([c[2] for c in counts], np.float64)
        used = np.unique(np.concatenate([codes >> 24, codes >> 16 & 255, codes >> 8 & 255,
                                         codes & 255])) if len(codes) else np.zeros(0, np.int64)
        self.k = len(used) + 1  # bytes that were never seen share the last sign
        self.signs = np.full(256, len(used), np.int32)
        self.signs[used] = np.arange(len(used))
        sign = [self.signs[codes >> s & 255].astype(np.int64) for s in (24, 16, 8, 0)]
        k, size = self.k, len(self.langs)
        # Runs of one to four signs: the last is predicted by the ones before it.
        flat = [sign[3]]
        for order in (1, 2, 3):
            flat.append(flat[-1] + sign[3 - order] * k ** order)
        spread = [np.arange(k), np.arange(k * k),
                  np.unique(np.concatenate((flat[2], flat[3] // k))), np.unique(flat[3])]
        lower = np.full((k, size), 8.0)  # without any context: 256 equal bytes
        self.escapes = []
        for order in range(4):
            runs = spread[order]
            at = np.searchsorted(runs, flat[order])
            seen = np.zeros((len(runs), size))
            np.add.at(seen, (at, lang), n)
            contexts, context = np.unique(runs // k, return_inverse=True)
            total = np.zeros((len(contexts), size))
            kinds = np.zeros((len(contexts), size))
            np.add.at(total, context, seen)
            np.add.at(kinds, context, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                hit = -np.log2(seen / (total + kinds)[context])
            shorter = lower[self._drop_first(runs, order, spread)]
            costs = np.where(seen > 0, hit, escape[context] + shorter)
            self.escapes.append((contexts, escape))
            lower = costs
            setattr(self, f"costs{order}", costs.astype(np.float32))
        self._index(spread)

    def _drop_first(self, runs: np.ndarray, order: int, spread: list[np.ndarray]) -> np.ndarray:
        """Where the run without its first sign stands among the shorter runs."""
        if order == 0:
            return runs
        short = runs % self.k ** order
        return short if order < 3 else np.searchsorted(spread[2], short)

    def _index(self, spread: list[np.ndarray]) -> None:
        k, size, threes = self.k, len(self.langs), spread[2]
        self.of_three = np.full(k ** 3, len(threes), np.int32)
        self.of_three[threes] = np.arange(len(threes))
        self.of_four = np.full((len(threes) + 1) * k, -1, np.int32)
        fours = spread[3]
        self.of_four[self.of_three[fours // k].astype(np.int64) * k + fours % k] = np.arange(
            len(fours))
        contexts, escape = self.escapes[2]
        self.escape2 = np.zeros((k * k, size), np.float32)
        self.escape2[contexts] = escape
        contexts, escape = self.escapes[3]
        self.escape3 = np.zeros((len(threes) + 1, size), np.float32)
        self.escape3[self.of_three[contexts]] = escape
        del self.escapes

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Code lengths of each byte after the first three, a row per byte, a column per language."""
        s = self.signs[data].astype(np.int64)
        k = self.k
        pair = s[1:-1] * k + s[2:]
        three = self.of_three[s[:-2] * (k * k) + pair]
        four = self.of_four[three[:-1].astype(np.int64) * k + s[3:]]
        out = self.costs3[four]
        miss = np.flatnonzero(four < 0)
        if len(miss):
            last, two = three[miss + 1], pair[miss + 1]
            known = last < len(self.costs2)
            less = self.escape2[pair[miss]] + self.costs1[two]
            less[known] = self.costs2[last[known]]
            out[miss] = self.escape3[three[miss]] + less
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of every whole text under every language."""
        out = np.zeros((len(texts), len(self.langs)))
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for lo in range(0, len(text), PIECE):
                held.append((i, (PAD + text[:lo])[-3:] + text[lo:lo + PIECE]
                             if lo < 3 else text[lo - 3:lo + PIECE]))
                size += len(held[-1][1])
                if size >= PIECE:
                    self._add(out, held)
                    held, size = [], 0
        if held:
            self._add(out, held)
        return out

    def _add(self, out: np.ndarray, held: list[tuple[int, bytes]]) -> None:
        bits = self.bits(np.frombuffer(b"".join(x for _, x in held), np.uint8))
        lengths = np.array([len(x) for _, x in held])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        cuts = np.column_stack((starts, starts + lengths - 3)).ravel()
        cuts[-1] = len(bits)
        sums = np.add.reduceat(bits, cuts[:-1], axis=0, dtype=np.float64)[::2]
        np.add.at(out, [i for i, _ in held], sums)


def _predict(trees):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trees.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            if model.langs and lettered:
                bits = model.code_lengths([texts[i].encode("utf-8", "surrogatepass")
                                           for i in lettered])
                best = bits.argmin(axis=1)
                with np.errstate(under="ignore"):
                    share = 1 / np.exp2(bits.min(axis=1)[:, None] - bits).sum(axis=1)
                for i, b, p in zip(lettered, best.tolist(), share.tolist(), strict=True):
                    langs[i], scores[i] = model.langs[b], p
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return rows


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    Learns from text and non-null lang of a sample of the rows whose crc32(doc_id as text) mod 4 is
    not 2 (``held_out`` where it is 2; false without a doc_id, and such rows teach nothing). Texts
    that are null or have no letter, or any text when nothing could be learned, are ``und`` with
    score 0. Ties go to the first language by name. Repeated rows repeat; the score is the share of
    the language among all learned ones when each is as likely as its code is short.
    """
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", "lang", F.coalesce(
        F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"))
    labelled = marked.filter("not held_out and doc_id is not null and lang is not null and "
                             "text is not null").select("doc_id", "lang", "text")
    counts = gram_counts(labelled, train_docs)
    trees = spark.sparkContext.broadcast(Trees([tuple(r) for r in counts.collect()]))
    return marked.select("doc_id", "held_out", "text").mapInArrow(
        _predict(trees), "doc_id long, held_out boolean, lang_pred string, score double")


def op3_language_ppm(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the language of every document."""
    return identify(table(spark, folder, "documents"))
