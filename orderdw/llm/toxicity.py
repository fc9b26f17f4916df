"""Toxicity by a weighted lexicon (operator 13).

Texts are folded first: case, accents, letters of other scripts that look Latin, and digits or signs
that stand for letters inside a word. An Aho-Corasick automaton then finds the entries of the
lexicon in one pass: words and beginnings of words, each with a weight. A hit inside an exception
phrase does not count, and of several entries for one word the heaviest does. Total, heaviest and
total by length go into a logistic model that gives the score.

Lexicon, exceptions and model are learned from labelled texts. Entries are words or word beginnings
that stand in toxic texts far more often than in others, exceptions are pairs of neighbouring words
around an entry that stand in clean texts. Near copies among the labelled texts count once (texts
that share the smallest hash of their five-word shingles), or else all words of a copied text would
look toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import table
from orderdw.llm.quality import fit, probabilities
from orderdw.session import cut_lineage

TRAIN_DOCS = 20_000  # about so many labelled texts are learned from, if there are more
MIN_DOCS = 3  # toxic texts that an entry needs, clean ones that an exception needs
PRIOR_DOCS = 5.0  # texts at the overall rate that each entry is mixed with
MIN_WEIGHT = 1.5  # log odds beyond the overall rate
BEGINNINGS = range(4, 9)  # lengths of word beginnings that can be entries
SHINGLE = 5
THRESHOLD = 0.5
HASH_STEPS = 1 << 30
# Letters that look like Latin ones, after lower-casing, and signs used for letters.
LOOK_ALIKES = dict(zip("абвгдеёзікклмнорстухѕјһԁԛԝαβγδεικνορτυχω",
                       "a6brdee3ikklmhopctyxsjhdqwabydeikvoptuxw", strict=True))
SIGNS = dict(zip("0134578@$!|", "oieastbasii", strict=True))
# The letter l, the letter i, the digit 1 and a bar are written for each other.
_FOLD = str.maketrans({**LOOK_ALIKES, "l": "i", "\u0131": "i", **dict.fromkeys(
    "\u00ad\u200b\u200c\u200d\u2060\ufeff")})  # the last are invisible and go
_SIGNS = str.maketrans(SIGNS)
_INSIDE = re.compile(r"(?:[0-9@$!|]+[^\W\d_]|[^\W\d_]+[0-9@$!|]+[^\W\d_])[^\W_@$!|]*"
                     r"(?:[@$!|]+[^\W_]+)*")
_OTHERS = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """The words of ``text`` in folded letters, each between two single spaces."""
    if not text:
        return " "
    if text.isascii():
        low = text.lower()
    else:
        low = unicodedata.normalize("NFKD", text.casefold())
        low = "".join(c for c in low if not unicodedata.combining(c)) if not low.isascii() else low
    low = _INSIDE.sub(lambda m: m[0].translate(_SIGNS), low.translate(_FOLD))
    return f" {_OTHERS.sub(' ', low).strip()} " if low else " "


@dataclass(frozen=True)
class Lexicon:
    """Entries ' word ' or ' beginning' with weights, exception phrases ' word word ', the model."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    model: dict = field(default_factory=dict)
    name: str = ""  # one for each trained lexicon: tasks build its automaton once


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), -float(phrase.index(" ", 1))))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """The weight of each word with an entry, by its place in ``folded``."""
        found: dict[int, float] = {}
        spared: list[int] = []
        if not len(self.automaton):
            return found
        for last, (size, weight) in self.automaton.iter(folded):
            first = last - size + 1
            if weight < 0:  # a phrase: how far its second word lies behind the first
                spared += (first, first - int(weight))
            elif weight > found.get(first, 0.0):
                found[first] = weight
        for at in spared:
            found.pop(at, None)
        return found


def features(matcher: Matcher, text: str | None) -> list[float]:
    """Total, heaviest, and total per hundred words (on log scales but the second)."""
    folded = fold(text)
    hits = matcher.hits(folded)
    if not hits:
        return [0.0, 0.0, 0.0]
    total, words = sum(hits.values()), max(1, folded.count(" ") - 1)
    return [math.log1p(total), max(hits.values()), math.log1p(100 * total / words)]


_matchers: dict[str, Matcher] = {}


def _matcher(lexicon: Lexicon) -> Matcher:
    if lexicon.name not in _matchers:
        _matchers.clear()
        _matchers[lexicon.name] = Matcher(lexicon)
    return _matchers[lexicon.name]


# -- learning ---------------------------------------------------------------------------------


def signature(folded: str) -> int:
    """The smallest hash of the five-word shingles: near copies share it, other texts do not."""
    words = folded.split()
    shingles = (" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))
    return min(xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in shingles) >> 1


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [fold(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), pa.array(map(signature, texts), pa.int64()),
             batch.column("toxic").cast(pa.int32())], ["folded", "signature", "toxic"])


def training_texts(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(folded, toxic) of a hash sample of about ``train_docs`` labelled rows of ``docs``, one of
    each group of near copies with the same label, stored."""
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")))
    n = known.count()
    picked = known.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(HASH_STEPS))
                          < min(1.0, train_docs / max(1, n)) * HASH_STEPS)
    rows = (docs.select("doc_id", "text")
            .join(F.broadcast(picked), "doc_id")  # bounded by the sample
            .select("text", "toxic"))
    folded = rows.mapInArrow(_folded, "folded string, signature long, toxic int")
    return cut_lineage(folded.groupBy("signature", "toxic").agg(F.min("folded").alias("folded"))
                       .select("folded", "toxic"), "toxic-texts")


def terms(folded: str) -> set[str]:
    """What can be an entry: the words of a text and the beginnings of its longer words."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in BEGINNINGS if len(w) > n}


def _phrases(entries: dict[str, float]):
    matcher = Matcher(Lexicon(entries))

    def of(folded: str) -> set[str]:
        found = set()
        for at in matcher.hits(folded):
            end = folded.index(" ", at + 1)
            if at:
                found.add(folded[folded.rindex(" ", 0, at):end + 1])
            if end < len(folded) - 1:
                found.add(folded[at:folded.index(" ", end + 1) + 1])
        return found

    return of


def _counted(of):
    """(term, toxic, clean): in how many of a partition's texts each term stands."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for folded, toxic in zip(batch.column("folded").to_pylist(),
                                     batch.column("toxic").to_pylist(), strict=True):
                counts[1 - toxic].update(of(folded))
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 *(pa.array([c[t] for t in names], pa.int64()) for c in counts)],
                ["term", "toxic", "clean"])
    return rows


def _counts(texts: DataFrame, of) -> DataFrame:
    return texts.mapInArrow(_counted(of), "term string, toxic long, clean long").groupBy(
        "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learned(texts: DataFrame) -> Lexicon:
    """The lexicon of :func:`training_texts`. Without texts of both kinds it has no entries."""
    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Lexicon({}, name=uuid4().hex)
    rate = totals[1] / (totals[0] + totals[1])
    odds = math.log(rate / (1 - rate))
    share = (F.col("toxic") + PRIOR_DOCS * rate) / (F.col("toxic") + F.col("clean") + PRIOR_DOCS)
    weighed = F.log(share / (1 - share)) - odds
    # At most as many entries as the sample's texts have terms in three toxic texts.
    rows = _counts(texts, terms).filter(F.col("toxic") >= MIN_DOCS).select(
        "term", weighed.alias("weight")).filter(F.col("weight") >= MIN_WEIGHT).collect()
    entries = {r["term"]: r["weight"] for r in rows}
    spared = _counts(texts, _phrases(entries)).filter(
        (F.col("clean") >= MIN_DOCS) & (weighed <= 0)).select("term").collect()
    lexicon = Lexicon(entries, frozenset(r["term"] for r in spared), name=uuid4().hex)
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)
    x = texts.mapInArrow(_features(shared, "folded"),
                         "x array<double>, toxic int").toPandas()  # bounded by the sample
    model = fit(np.stack(x["x"].to_numpy()), x["toxic"].to_numpy(np.float64))
    return Lexicon(lexicon.weights, lexicon.exceptions, model, uuid4().hex)


def _features(lexicon, column: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(lexicon.value)
        for batch in batches:
            x = [features(matcher, t) for t in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])
    return rows


def _scored(lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, model = _matcher(lexicon.value), lexicon.value.model
        for batch in batches:
            x = np.array([features(matcher, t) for t in batch.column("text").to_pylist()])
            p = probabilities(model, x.reshape(-1, 3)) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])
    return rows


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text): how likely its text is toxic, from
    the text alone.

    A null, empty or wordless text has the score of a text without hits. A lexicon without entries
    gives 0 throughout. Repeated rows repeat, rows without a doc_id are scored like others, other
    columns are left out, an empty table gives an empty one. Texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the training sample
    return docs.select("doc_id", "text").mapInArrow(_scored(shared), "doc_id long, score double")


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Lexicon:
    """The lexicon of the labelled ones of ``docs`` (doc_id, text). ``labels`` has doc_id and toxic,
    0 or 1; several labels of a document count as their mean, rounded up."""
    return learned(training_texts(docs, labels, train_docs))


def op13_toxic_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the toxicity of every document, learned from four fifths of the ids."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lexicon = train(docs.filter(~held_out), labels.filter(~held_out))
    return score(docs, lexicon).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
