"""Alignment of two tokenizers over the same bytes (operator 12).

Each text is encoded by both tokenizers. A list holds the byte offset after each of a text's tokens;
where both lists hold the same offset, the two token sequences are cut. The common offsets are found
by galloping: for every end of the shorter list, exponential steps in the longer one bracket its
place, and a binary search in the bracket ends it. The indices found slice both sequences into
groups, and their differences say how many tokens of each side overlap in a group.

How often two ids end together in the whole corpus is an aggregate. Texts do not travel for it: the
links of many documents stay packed in a block, the block asks for each of its id pairs once, and
the counts come back to the block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderdw.llm.common import bucketed, packed, spread, table, unpacked
from orderdw.session import cut_lineage

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed: how byte-level vocabularies of this family cut a text before they merge.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_SPACE = "▁"
TEXT_BYTES = 1 << 20  # texts that are encoded and aligned together, unless one is longer
BLOCK_LINKS = 1 << 20  # links of a block, unless one text has more
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for
    themselves, the others are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@dataclass(frozen=True)
class Models:
    """The two tokenizers' files as they are read on the driver and sent to the tasks."""

    byte_json: str
    piece_model: bytes


def load_models(byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL) -> Models:
    with open(byte_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        return Models(f.read(), g.read())


class Tokenizers:
    """Both encoders and the bytes of their tokens."""

    def __init__(self, models: Models) -> None:
        byte_of = _byte_of()
        vocab = json.loads(models.byte_json)["model"]["vocab"]
        ranks = {bytes(byte_of[c] for c in entry): i for entry, i in vocab.items()}
        self.a = tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks,
                                   special_tokens={})
        entries = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            entries[i] = entry
        self.a_bytes = pa.array(entries, pa.large_binary())
        self.b = sentencepiece.SentencePieceProcessor(model_proto=models.piece_model)
        pieces = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else
                  self.b.id_to_piece(i).replace(PIECE_SPACE, " ").encode()
                  for i in range(self.b.get_piece_size())]
        self.b_bytes = pa.array(pieces, pa.large_binary())
        self.sizes = [pc.binary_length(x).to_numpy() for x in (self.a_bytes, self.b_bytes)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides of each text; none where a side's bytes are not space and text."""
        a = [self.a.encode_to_numpy(" " + t).astype(np.int64) if t else _NONE for t in texts]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)] if texts else []
        for n, text in enumerate(texts):
            wanted = b" " + text.encode()
            if not (len(a[n]) and len(b[n]) and self._joined(self.a_bytes, a[n]) == wanted
                    and self._joined(self.b_bytes, b[n]) == wanted):
                a[n] = b[n] = _NONE
        return a, b

    @staticmethod
    def _joined(entries: pa.Array, ids: np.ndarray) -> bytes:
        taken = entries.take(pa.array(ids))
        end = int(np.frombuffer(taken.buffers()[1], np.int64)[len(ids)])
        return taken.buffers()[2].slice(0, end).to_pybytes()


_NONE = np.empty(0, np.int64)


@cache
def _tokenizers(models: Models) -> Tokenizers:
    """Once for each Python worker."""
    return Tokenizers(models)


def gallop(wanted: np.ndarray, among: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of ``wanted`` the first index of the ascending ``among`` whose value is not below
    it: steps of 1, 2, 4 ... from ``start``, away from too small or too large a value, then a binary
    search between the last two steps. All searches advance together."""
    last = len(among)
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), last)
    below = among[start] < wanted
    for way in (1, -1):
        open_ = np.flatnonzero(below if way > 0 else ~below)
        if way > 0:
            low[open_] = start[open_] + 1
        else:
            high[open_] = start[open_]
        step = 1
        while len(open_):
            at = start[open_] + way * step
            inside = (at >= 0) & (at < last)
            value = among[np.clip(at, 0, last - 1)]
            onward = inside & ((value < wanted[open_]) == (way > 0))
            done, go = open_[~onward], open_[onward]
            if way > 0:
                low[go] = at[onward] + 1
                high[done] = np.minimum(at[~onward], last)
            else:
                high[go] = at[onward]
                low[done] = np.maximum(at[~onward] + 1, 0)
            open_, step = go, 2 * step
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = among[middle] < wanted[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(a_ends: np.ndarray, a_cuts: np.ndarray, b_ends: np.ndarray, b_cuts: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index in a_ends, index in b_ends) of all offsets that both lists of a row hold.

    The lists of row r are ``a_ends[a_cuts[r]:a_cuts[r + 1]]`` and the same of b, ascending. Each
    row's shorter list drives the search in its longer one.
    """
    n_a, n_b = np.diff(a_cuts), np.diff(b_cuts)
    both = (n_a > 0) & (n_b > 0)
    found = []
    for short, long_, drives in (((a_ends, a_cuts, n_a), (b_ends, b_cuts, n_b), n_a <= n_b),
                                 ((b_ends, b_cuts, n_b), (a_ends, a_cuts, n_a), n_b < n_a)):
        rows = np.flatnonzero(both & drives)
        if not len(rows):
            continue
        (s_ends, s_cuts, s_n), (l_ends, l_cuts, l_n) = short, long_
        s_at, l_at = spread(s_cuts[rows], s_n[rows]), spread(l_cuts[rows], l_n[rows])
        row = np.repeat(rows, s_n[rows])
        # One ascending list: each row's offsets lie above all of the row before it.
        top = np.maximum.reduceat(np.concatenate((s_ends[s_at], [0])), np.concatenate((
            [0], np.cumsum(s_n[rows])[:-1])))
        top = np.maximum(top, l_ends[l_cuts[rows] + l_n[rows] - 1])
        base = np.cumsum(top + 1) - (top + 1)
        wanted = s_ends[s_at] + np.repeat(base, s_n[rows])
        among = l_ends[l_at] + np.repeat(base, l_n[rows])
        first = np.cumsum(l_n[rows]) - l_n[rows]
        rank = np.arange(len(s_at)) - np.repeat(np.cumsum(s_n[rows]) - s_n[rows], s_n[rows])
        start = np.repeat(first, s_n[rows]) + rank * np.repeat(l_n[rows], s_n[rows]) // np.repeat(
            s_n[rows], s_n[rows])
        at = gallop(wanted, among, start)
        same = at < len(among)
        same[same] = among[at[same]] == wanted[same]
        pair = (s_at[same], l_at[at[same]])
        found.append((row[same], *(pair if short[0] is a_ends else pair[::-1])))
    if not found:
        return _NONE, _NONE, _NONE
    row, in_a, in_b = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(in_a, kind="stable")
    return row[order], in_a[order], in_b[order]


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))


def aligned(texts: list[str], tokenizers: Tokenizers) -> list[pa.ListArray]:
    """a_ids, b_ids, a_ends, b_ends of texts."""
    ids = tokenizers.encode(texts)
    cuts = [np.cumsum([0, *map(len, side)]) for side in ids]
    flat = [np.concatenate([_NONE, *side]) for side in ids]
    ends = []
    for side, cut, sizes in zip(flat, cuts, tokenizers.sizes, strict=True):
        total = np.concatenate(([0], np.cumsum(sizes[side])))
        ends.append(total[1:] - np.repeat(total[cut[:-1]], np.diff(cut)))
    row, in_a, in_b = common_ends(ends[0], cuts[0], ends[1], cuts[1])
    groups = np.searchsorted(row, np.arange(len(texts) + 1))
    return [_lists(flat[0], cuts[0]), _lists(flat[1], cuts[1]),
            _lists(in_a + 1 - cuts[0][row], groups), _lists(in_b + 1 - cuts[1][row], groups)]


def _align(models):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(models.value)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            share = np.cumsum(size) // TEXT_BYTES
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(share)) + 1):
                if len(part):
                    some = batch.slice(int(part[0]), len(part))
                    texts = [t or "" for t in some.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), *aligned(texts, tokenizers)],
                        ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])
    return rows


def alignments(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends) of every row of ``docs`` (doc_id, text).

    Both tokenizers encode a space and the text, without special tokens. Group g of a text holds the
    ids ``a_ids[a_ends[g - 1]:a_ends[g]]`` and ``b_ids[b_ends[g - 1]:b_ends[g]]`` (from 0 for the
    first): between two offsets at which tokens of both sides end. Null and empty texts, and texts
    that a side cannot give back byte by byte, have empty lists. Repeated rows and rows without a
    doc_id are aligned like others; other columns are left out; an empty table gives an empty one. A
    text is held whole by its task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models or load_models())  # two files, 2 MB
    return docs.select("doc_id", "text").mapInArrow(_align(shared), ALIGNED)


class _Written:
    """The text of groups, ``a1,a2|b1;a3|b2,b3``, put together from strings of single ids."""

    def __init__(self, ids: int) -> None:
        self.ids = ids
        self.strings = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(ids)],
                                pa.large_string())

    def digests(self, a, a_cuts, b, b_cuts, in_a, in_b, groups) -> list[str]:
        n_a, n_b = (np.diff(np.concatenate(([0], x + 1))) for x in (in_a, in_b))
        before_b, with_a = np.cumsum(n_b) - n_b, np.cumsum(n_a)
        at_a = np.arange(len(a)) + np.repeat(before_b, n_a)
        at_b = np.arange(len(b)) + np.repeat(with_a, n_b)
        picked = np.empty(len(a) + len(b), np.int64)
        picked[at_a], picked[at_b] = a, b
        picked[at_a[in_a]] += self.ids
        picked[at_b[in_b]] += 2 * self.ids
        taken = self.strings.take(pa.array(picked))
        cuts = np.frombuffer(taken.buffers()[1], np.int64)[a_cuts + b_cuts].tolist()
        data = memoryview(taken.buffers()[2] or b"")
        return [hashlib.sha256(data[lo:hi - 1]).hexdigest() if hi > lo else ""
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = column.offsets.to_numpy().astype(np.int64)
    return values, cuts - cuts[0]


SUMMARY = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]


def _summary(batch: pa.RecordBatch, written: _Written, width: int
             ) -> tuple[pa.RecordBatch, np.ndarray]:
    """Columns of :data:`SUMMARY` without links, and the links of all rows as pair numbers."""
    (a, a_cuts), (b, b_cuts), (a_ends, groups), (b_ends, _) = map(_flat, batch.columns[1:])
    many = np.diff(groups)
    in_a = a_ends - 1 + np.repeat(a_cuts[:-1], many)
    in_b = b_ends - 1 + np.repeat(b_cuts[:-1], many)
    digests = written.digests(a, a_cuts, b, b_cuts, in_a, in_b, groups)
    counts = [pa.array(np.diff(x), pa.int64()) for x in (a_cuts, b_cuts, groups)]
    return pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests, pa.string())],
                                      SUMMARY[:-1]), a[in_a] * width + b[in_b]


def _blocks(width: int, ids: int, block_links: int):
    """Rows of a partition as blocks: their packed summaries, the pairs they link, how often."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written, first = _Written(ids), TaskContext.get().partitionId() << 32
        held, links, made = [], [], 0

        def block() -> pa.RecordBatch:
            pairs, place, n = np.unique(np.concatenate([_NONE, *links]), return_inverse=True,
                                        return_counts=True)
            cuts = np.cumsum([0, *map(len, links)])
            parts = []
            for part, lo, hi in zip(held, cuts[:-1], cuts[1:], strict=True):
                groups = np.concatenate(([0], np.cumsum(part.column(3).to_numpy())))
                parts.append(pa.RecordBatch.from_arrays(
                    [*part.columns, _lists(place[lo:hi], groups)], SUMMARY))
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([packed(parts)], pa.binary()),
                 pa.array([pairs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64()))],
                ["block", "docs", "pairs", "links"])

        for batch in batches:
            total = np.cumsum(pc.list_value_length(batch.column(3)).to_numpy())
            share = total // (block_links // 4)
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(share)) + 1):
                if len(part):
                    docs, own = _summary(batch.slice(int(part[0]), len(part)), written, width)
                    held.append(docs)
                    links.append(own)
                    if sum(map(len, links)) >= block_links or sum(
                            p.num_rows for p in held) >= 1 << 16:
                        yield block()
                        held, links, made = [], [], made + 1
        if held:
            yield block()
    return rows


def link_counts(blocks: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair of ids, and whether no other pair
    of its b id has more."""
    n = (blocks.select(F.explode(F.arrays_zip("pairs", "links")).alias("x"))
         .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.links").alias("n")))
    of_b = Window.partitionBy(F.pmod("pair", F.lit(width)))  # as many rows as a has entries at most
    return n.withColumn("best", F.col("n") == F.max("n").over(of_b))


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            answers = batch.column(2)[row].values
            n = best = _NONE
            if answers is not None and len(answers):
                at, n, best = (answers.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                               for c in ("at", "n", "best"))
                order = np.argsort(at)
                n, best = n[order], best[order]
            for part in unpacked(batch.column(1)[row].as_buffer()):
                place, groups = _flat(part.column(5))
                sums = []
                for values in (best, n):
                    total = np.concatenate(([0], np.cumsum(values[place])))[groups]
                    sums.append(pa.array(np.diff(total), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], part.column(3), *sums, part.column(4)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                     "groups_sha256"])


def link_summary(rows: DataFrame, models: Models, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Digest of every row of :func:`alignments`: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Every token has a byte at least, so one token of each side ends at a common offset and a group
    is one link. A row without tokens has zeros and an empty digest. Equal rows count each in the
    corpus; ties for the best of a b id are all best.
    """
    spark = rows.sparkSession
    tokenizers = _tokenizers(models)
    width, ids = len(tokenizers.b_bytes), max(len(tokenizers.a_bytes), len(tokenizers.b_bytes))
    # Bucketed by block: the counts come to the documents, which stay where they are.
    blocks = bucketed(rows.mapInArrow(
        _blocks(width, ids, block_links),
        "block long, docs binary, pairs array<long>, links array<long>"), "block", "align_blocks")
    counts = cut_lineage(link_counts(blocks, width), "link-counts")
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").groupBy("block").agg(
        F.collect_list(F.struct("at", "n", "best")).alias("answers"))  # as many as a block's pairs
    return (blocks.select("block", "docs").join(answers, "block", "left")
            .select("block", "docs", "answers")
            .mapInArrow(_answered, "doc_id long, n_a long, n_b long, n_groups long, n_links long,"
                        " n_best long, count_sum long, groups_sha256 string"))


def op12_gallop_align(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the alignment of every document, with corpus-wide counts of its id pairs."""
    models = load_models()
    return link_summary(alignments(table(spark, folder, "documents"), models), models)
