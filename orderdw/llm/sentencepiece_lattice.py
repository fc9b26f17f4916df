"""SentencePiece encoding and decoding over a relational lattice (operator 9).

Texts are cut into words at places that no piece of the vocabulary spans, so words are encoded one by
one, and each distinct word once. Its substrings of bounded length join the piece table by equality;
the matches are the edges of the word's lattice, grouped by word, and a higher-order aggregate folds
them into the word's ids:

* a unigram model takes the best sum of scores (Viterbi);
* a merge model (BPE) joins, again and again, the two neighbours that form the best piece. Its
  encoder is not a best path by score, so Viterbi would give other ids than the model means.

Documents travel in compressed blocks of bounded size. A block asks for each of its words once, and
the answers come back to the block, so no task holds the whole dictionary and frequent words are
asked for once per block, not once per occurrence. Requests and answers are packed by word bucket.
Decoding puts the bytes of the ids side by side.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import bucketed, packed, spread, table, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BLOCK_BYTES = 8 << 20
BETWEEN = "\x01"  # stands between the words of a request; words that hold it are encoded as long ones
WORD_TASKS = 4  # lattices take room: their stage has so many times the usual number of tasks
HASHED_GROUPS, WORDS_HASHED = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 100_000
LONG_WORD = 60  # longer words are encoded beside their texts, for a bit mask holds no more
ASKING_BLOCKS = 4096  # a word is answered for so many blocks at once
UNKNOWN_PENALTY = 10.0
NO_PIECE = (1 << 20) - 1  # the rank and id of a character without a piece
UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


# What ASCII has besides letters; and words of units whose other characters are letters.
_ASCII_OTHERS = {c: None for c in range(128) if not chr(c).isalpha()}
_PLAIN = re.compile("[A-Za-z\x80-\U0010ffff]+|[\x00-@\\[-`{-\x7f]+")


@cache
def _parts() -> re.Pattern:
    """A word is letters with the marks that combine with them, or anything else, numbers too."""
    def all_of(*kinds: str) -> str:
        planes = (*range(0x80, 0x20000), *range(0xE0000, 0xE0200))  # no marks or numbers elsewhere
        return re.escape("".join(c for c in map(chr, planes) if unicodedata.category(c) in kinds))

    marks, numbers = all_of("Mn", "Mc", "Me"), all_of("No", "Nl")
    return re.compile(f"{SPACE}*(?:(?:[^\\W\\d_{numbers}]+|[{marks}]+)+"
                      f"|(?:[^\\w{SPACE}{marks}]|[\\d_{numbers}])+)|{SPACE}+")


def words_of(unit: str) -> list[str]:
    """The words of a unit that stands behind a space sign; the sign belongs to the first."""
    if unit and (unit.isascii() or not (letters := unit.translate(_ASCII_OTHERS))
                 or letters.isalpha()):
        first, *rest = _PLAIN.findall(unit)
        return [SPACE + first, *rest]
    return _parts().findall(SPACE + unit)


@dataclass
class Vocabulary:
    """Pieces of a model: text, id and score; ids of the 256 byte pieces start at ``first_byte``."""

    kind: str
    pieces: list[tuple[str, int, float]]
    first_byte: int | None
    unknown: int
    texts: list[str]
    fine: bool = field(init=False)

    def __post_init__(self) -> None:
        whole = [p for p, _, _ in self.pieces]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in whole):
            raise ValueError("a piece spans the end of a word")
        if any(i >= NO_PIECE for _, i, _ in self.pieces):
            raise ValueError("an edge has room for ids below a million")
        self.fine = all(len(words_of(p.lstrip(SPACE))) == 1 for p in whole)
        self.longest = max(map(len, whole), default=1)
        order = {s: n for n, s in enumerate(sorted({-s for _, _, s in self.pieces}))}
        self.ranks = {p: (order[-s], i) for p, i, s in self.pieces}
        self.lowest = min((s for _, _, s in self.pieces), default=0.0)

    def words(self, unit: str) -> list[str]:
        return words_of(unit) if self.fine else [SPACE + unit]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(piece, id, rank, score, late), as an Arrow table: rows would start Python workers that
        only unpickle them, and stay."""
        kinds = {"piece": pa.string(), "id": pa.int32(), "rank": pa.int32(), "score": pa.float64(),
                 "late": pa.bool_()}
        rows = [(p, i, self.ranks[p][0], float(s), self.late(p)) for p, i, s in self.pieces]
        columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
        return spark.createDataFrame(pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds)))

    def reaches(self, slots: int = 1 << 16) -> list[int]:
        """For each hash of three first characters, the length of the longest piece with them."""
        out = [min(2, self.longest)] * slots
        for piece, _, _ in self.pieces:
            slot = zlib.crc32(piece[:3].encode("utf-8", "surrogatepass")) % slots
            out[slot] = max(out[slot], len(piece))
        return out

    def late(self, piece: str) -> bool:
        """Whether parts of the piece may be merged after its own turn."""
        mine = self.ranks[piece][0]
        return any(len(part) > 1 and self.ranks[part][0] >= mine
                   for k in range(1, len(piece))
                   if piece[:k] in self.ranks and piece[k:] in self.ranks
                   for part in (piece[:k], piece[k:]))


def load_vocabulary(path: str = MODEL, kind: str = "bpe") -> Vocabulary:
    """Read a model file. ``kind`` is the model's own: ``bpe`` or ``unigram``."""
    import sentencepiece

    if kind not in ("bpe", "unigram"):
        raise ValueError("kind is bpe or unigram")
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    size = p.vocab_size()
    bytes_ = [i for i in range(size) if p.is_byte(i)]
    if bytes_ and [p.id_to_piece(i) for i in bytes_] != [f"<0x{b:02X}>" for b in range(256)]:
        raise ValueError("the byte pieces are not in order")
    if bytes_ and bytes_ != list(range(bytes_[0], bytes_[0] + 256)):
        raise ValueError("the byte pieces do not follow each other")
    pieces = [(p.id_to_piece(i), i, p.get_score(i)) for i in range(size)
              if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    texts = ["" if p.is_control(i) else p.id_to_piece(i) for i in range(size)]
    return Vocabulary(kind, pieces, bytes_[0] if bytes_ else None, p.unk_id(), texts)


def units_of(text: str) -> list[str]:
    """Space-led units of a text, each without its first space sign."""
    if not text:
        return []
    if text[0] != " " and "  " not in text and SPACE not in text:
        return text.split(" ")
    return [u[1:] for u in UNITS.findall(SPACE + text.replace(" ", SPACE))]


def _unknown_ids(vocabulary: Vocabulary, char: str) -> list[int]:
    if vocabulary.first_byte is None:
        return [vocabulary.unknown]
    return [vocabulary.first_byte + b for b in char.encode("utf-8", "surrogatepass")]


def encode_long(vocabulary: Vocabulary, word: str) -> list[int]:
    """Ids of one word of any length, in n log n steps (merges) or n steps (Viterbi)."""
    ranks = vocabulary.ranks
    n = len(word)
    if vocabulary.kind == "unigram":
        scores = {p: s for p, _, s in vocabulary.pieces}
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - vocabulary.longest), end):
                score = scores.get(word[start:end])
                if score is None:
                    if end - start > 1:
                        continue
                    score = vocabulary.lowest - UNKNOWN_PENALTY
                if best[start] + score > best[end]:
                    best[end], back[end] = best[start] + score, start
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
    else:
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            if start >= 0 and end[start] < n:
                stop = end[end[start]]
                if stop - start <= vocabulary.longest and word[start:stop] in ranks:
                    heapq.heappush(heap, (ranks[word[start:stop]][0], start, stop))

        for start in range(n):
            offer(start)
        while heap:
            _, start, stop = heapq.heappop(heap)
            if not alive[start] or end[start] >= stop or end[end[start]] != stop:
                continue
            alive[end[start]] = False
            end[start] = stop
            if stop < n:
                before[stop] = start
            offer(before[start])
            offer(start)
        cuts = [i for i in range(n) if alive[i]] + [n]
    out: list[int] = []
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        known = ranks.get(word[start:stop])
        out.extend([known[1]] if known else _unknown_ids(vocabulary, word[start:stop]))
    return out


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position)


def _start(code: Column) -> Column:
    return F.shiftright(code, 26).bitwiseAND(F.lit(63).cast("long")).cast("int")


def _end(code: Column) -> Column:
    return F.shiftright(code, 20).bitwiseAND(F.lit(63).cast("long")).cast("int")


def _ends(code: Column) -> Column:
    return _bit(_start(code)).bitwiseOR(_bit(_end(code)))


def _inner(code: Column) -> Column:
    return _bit(_end(code)) - _bit(_start(code) + 1)


def _span(code: Column) -> Column:
    return _bit(_end(code) + 1) - _bit(_start(code))


def _merged(edges: Column, n: Column) -> Column:
    """Boundaries (bits) that are left when the best available edge is merged until none is.

    Edges are in order of rank and start; one is available when it begins and ends at a boundary and
    has exactly one boundary inside. One pass in this order merges the same edges, unless an edge
    comes up too early, with more boundaries inside, whose parts may be merged after its turn. The
    pass marks words where that could be; those are merged step by step.
    """
    every = _bit(n) + _bit(n) - 1
    too_early = F.lit(1 << 62).cast("long")

    def take(mask: Column, code: Column) -> Column:
        met = F.bit_count(mask.bitwiseAND(_span(code)))  # three: both ends and one inside
        at_ends = mask.bitwiseAND(_ends(code)) == _ends(code)
        return F.when((met == 3) & at_ends, mask.bitwiseAND(F.bitwise_not(_inner(code)))).when(
            (code < 0) & (met > 3) & at_ends, mask.bitwiseOR(too_early)).otherwise(mask)

    def step(mask: Column, _: Column) -> Column:
        ready = F.get(F.filter(edges, lambda c: (
            F.bit_count(mask.bitwiseAND(_span(c))) == 3)
            & (mask.bitwiseAND(_ends(c)) == _ends(c))), F.lit(0))
        return F.when(ready.isNull(), mask).otherwise(
            mask.bitwiseAND(F.bitwise_not(_inner(ready))))

    return F.aggregate(edges, every, take, lambda once: F.when(once < too_early, once).otherwise(
        F.aggregate(F.sequence(F.lit(1), n), every, step)))


def _best_path(edges: Column, n: Column) -> Column:
    """Boundaries (bits) of the path with the largest sum of scores."""
    start = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(1).cast("long").alias("mask")))

    def step(states: Column, end: Column) -> Column:
        ways = F.transform(
            F.filter(edges, lambda e: e["end"] == end),
            lambda e: F.struct((F.get(states, e["start"])["total"] + e["score"]).alias("total"),
                               F.get(states, e["start"])["mask"].bitwiseOR(_bit(end))
                               .alias("mask")))
        return F.concat(states, F.array(F.array_max(ways)))

    states = F.aggregate(F.sequence(F.lit(1), n), start, step)
    return F.element_at(states, -1)["mask"]


def _of_single(vocabulary: Vocabulary, char: Column) -> Column:
    """The id of a one-character piece, or NO_PIECE: a place in an array, by code point."""
    low, high = [NO_PIECE] * (1 << 16), {}
    for piece, i, _ in vocabulary.pieces:
        if len(piece) == 1:
            if ord(piece) < len(low):
                low[ord(piece)] = i
            else:
                high[ord(piece)] = i
    point = F.ascii(char)
    found = F.get(F.split(F.lit(",".join(map(str, low))), ",").cast("array<int>"), point)
    if high:
        others = F.create_map(*[F.lit(x) for pair in high.items() for x in pair])
        found = F.when(point >= len(low), F.get(F.array(others[point]), F.lit(0))).otherwise(found)
    return F.coalesce(found, F.lit(NO_PIECE))


def _substrings(words: DataFrame, reaches: list[int], shortest: int) -> DataFrame:
    """The substrings (piece) of words that can be pieces of ``shortest`` characters or more, with
    start and end; and for each word one row with its first character, which alone carries its asks."""
    n = F.length("word")
    # How long a piece with these first three characters can be, by their hash; two if none has them.
    reach = F.get(F.split(F.lit(",".join(map(str, reaches))), ",").cast("array<int>"), F.pmod(
        F.crc32(F.expr("substring(word, start + 1, 3)").cast("binary")), F.lit(len(reaches)))
        .cast("int"))
    return (words.withColumn("start", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("end", F.explode(F.sequence(
                F.col("start") + 1, F.least(n, F.col("start") + reach))))
            .filter((F.col("end") >= F.col("start") + shortest) | (F.col("end") == 1))
            .withColumn("asks", F.when(F.col("end") == 1, F.col("asks")))
            .withColumn("piece", F.expr("substring(word, start + 1, end - start)")))


def _ids(vocabulary: Vocabulary, starts_and_ids: Column) -> Column:
    """Ids of (start << 20 | id) in order, with the bytes of characters that have no piece."""
    def plain(x: Column) -> Column:
        return x.bitwiseAND(F.lit(NO_PIECE).cast("long")).cast("int")

    def unknown(x: Column) -> Column:
        if vocabulary.first_byte is None:
            return F.array(F.lit(vocabulary.unknown))
        byte = F.hex(F.substring("word", F.shiftright(x, 20).cast("int") + 1, F.lit(1)))
        return F.transform(F.sequence(F.lit(1), F.length(byte), F.lit(2)), lambda i: (
            F.conv(F.substring(byte, i, F.lit(2)), 16, 10).cast("int") + vocabulary.first_byte))

    strange = F.exists(starts_and_ids, lambda x: plain(x) == NO_PIECE)
    return F.when(~strange, F.transform(starts_and_ids, plain)).otherwise(
        F.flatten(F.transform(starts_and_ids, lambda x: F.when(
            plain(x) == NO_PIECE, unknown(x)).otherwise(F.array(plain(x))))))


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``words`` (distinct rows of bucket, word, asks; no word above LONG_WORD) with ``ids``.

    The rows should be partitioned by bucket: substrings and edges then stay where their word is.
    An edge of a merge model is one number: rank, start, end and id, and while edges are put in
    order a last bit, which marks pieces that could be merged after their turn. A row for each edge
    would take several times the room. Afterwards a negative sign is the mark.
    """
    pieces = F.broadcast(vocabulary.frame(words.sparkSession))  # as large as the vocabulary
    return (_encode_merges if vocabulary.kind == "bpe" else _encode_best)(words, pieces, vocabulary)


def _encode_merges(words: DataFrame, pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    n = F.length("word")
    met = (_substrings(words, vocabulary.reaches(), 2).join(pieces, "piece", "left")
           .filter("id is not null and end > start + 1 or end = 1"))
    code = F.col("rank").cast("long")
    for name, bits in (("start", 6), ("end", 6), ("id", 20)):
        code = F.shiftleft(code, bits).bitwiseOR(F.col(name).cast("long"))
    code = F.shiftleft(code, 1).bitwiseOR(F.col("late").cast("long"))
    lattices = met.groupBy("bucket", "word").agg(
        F.first("asks", ignorenulls=True).alias("asks"), F.sort_array(F.collect_list(
            F.when(F.col("end") > F.col("start") + 1, code))).alias("edges"))
    # The order is by code; the mark goes into its sign afterwards: the last bit becomes the first.
    lattices = lattices.withColumn("edges", F.transform("edges", lambda e: F.shiftright(
        e, 1).bitwiseOR(F.shiftleft(e, 63))))
    cut = lattices.withColumn("mask", _merged(F.col("edges"), n))
    mask = F.col("mask")

    def named(start: Column, piece: Column) -> Column:
        return F.shiftleft(start.cast("long"), 20).bitwiseOR(piece.cast("long"))

    used = F.transform(
        F.filter("edges", lambda c: mask.bitwiseAND(_span(c)) == _ends(c)),
        lambda c: named(_start(c), c.bitwiseAND(F.lit(NO_PIECE).cast("long"))))
    alone = F.transform(
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.bit_count(
            mask.bitwiseAND(_bit(i) + _bit(i + 1))) == 2),
        lambda i: named(i, _of_single(vocabulary, F.substring("word", i + 1, F.lit(1)))))
    return cut.select("bucket", "word", "asks",
                      F.sort_array(F.concat(used, alone)).alias("used")).select(
        "bucket", "word", "asks", _ids(vocabulary, F.col("used")).alias("ids"))


def _encode_best(words: DataFrame, pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    n = F.length("word")
    met = (_substrings(words, vocabulary.reaches(), 1).join(pieces, "piece", "left")
           .filter("id is not null or end = start + 1"))
    edge = F.struct("start", "end", F.coalesce("id", F.lit(NO_PIECE)).alias("id"), F.coalesce(
        "score", F.lit(vocabulary.lowest - UNKNOWN_PENALTY)).alias("score"))
    cut = met.groupBy("bucket", "word").agg(
        F.first("asks", ignorenulls=True).alias("asks"), F.collect_list(edge).alias("edges")
    ).withColumn("mask", _best_path(F.col("edges"), n))

    def on_path(e: Column) -> Column:
        return F.col("mask").bitwiseAND(_bit(e["end"] + 1) - _bit(e["start"])) == (
            _bit(e["start"]).bitwiseOR(_bit(e["end"])))

    used = F.sort_array(F.transform(F.filter("edges", on_path), lambda e: F.shiftleft(
        e["start"].cast("long"), 20).bitwiseOR(e["id"].cast("long"))))
    return cut.select("bucket", "word", "asks", _ids(vocabulary, used).alias("ids"))


def _parsed(parts: list[pa.StringArray]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The distinct units of texts, the number of each unit in turn, and how many a text has. Texts
    are cut part by part: all units of a block take many times its room, its distinct ones little."""
    units, numbers, sizes = zip(*map(_parsed_part, parts), strict=True)
    coded = pa.concat_arrays(units).dictionary_encode()
    starts = np.cumsum([0, *map(len, units)])
    places = coded.indices.to_numpy()
    return (coded.dictionary, np.concatenate([places[lo:][own] for lo, own in zip(
        starts[:-1], numbers, strict=True)]), np.concatenate(sizes))


def _parsed_part(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    # Texts with single spaces only are cut by Arrow, the others one by one.
    odd = pc.fill_null(pc.or_(pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  ")),
                              pc.match_substring(texts, SPACE)), False)
    skip = pc.or_(odd, pc.fill_null(pc.equal(texts, ""), True))
    lists = pc.split_pattern(pc.if_else(skip, pa.scalar(None, pa.string()), texts), " ")
    rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    plain, own = lists.flatten(), [units_of(texts[row].as_py()) for row in rows.tolist()]
    coded = _coded(plain, [u for units in own for u in units])
    cuts = lists.offsets.to_numpy().astype(np.int64)
    begin, sizes = cuts[:-1].copy(), np.diff(cuts)
    sizes[rows] = [len(units) for units in own]
    begin[rows] = len(plain) + np.cumsum(sizes[rows]) - sizes[rows]
    return coded.dictionary, coded.indices.to_numpy()[spread(begin, sizes)], sizes


def _coded(first: pa.StringArray, then: list[str]) -> pa.DictionaryArray:
    return pa.concat_arrays([first, pa.array(then, pa.string())]).dictionary_encode()


def _blocks(block_bytes: int):
    """The rows of a partition as blocks (block, texts) of bounded size."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        first, made = TaskContext.get().partitionId() << 32, 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([packed(held)], pa.binary())],
                ["block", "texts"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                held.append(batch.slice(lo, 256))
                size += held[-1].column(1).nbytes
                if size >= block_bytes:
                    yield block()
                    held, size, made = [], 0, made + 1
        if held:
            yield block()
    return rows


class _Block:
    """The texts of a block, their units as words, and the words to ask for, by bucket."""

    def __init__(self, data: pa.Buffer, block: int, vocabulary: Vocabulary, buckets: int,
                 salts: int) -> None:
        self.parts = unpacked(data)
        units, self.numbers, self.sizes = _parsed([p.column(1) for p in self.parts])
        # A unit of letters is one word, the others are cut. Not to cut is right for any unit.
        whole = (pc.utf8_is_alpha(units).to_numpy(zero_copy_only=False) if vocabulary.fine
                 else np.ones(len(units), bool))
        cut, many = [], []
        for unit in units.filter(pa.array(~whole)).to_pylist():
            own = vocabulary.words(unit)
            cut += own
            many.append(len(own))
        alone = pc.binary_join_element_wise(SPACE, units.filter(pa.array(whole)), "")
        coded = _coded(alone, cut)
        words, numbers = coded.dictionary, coded.indices.to_numpy()
        # The words of unit u: many[u] of them from first[u] on.
        self.many, self.first = np.ones(len(units), np.int64), np.empty(len(units), np.int64)
        self.many[~whole] = many
        self.first[whole] = np.arange(len(alone))
        self.first[~whole] = len(alone) + np.cumsum(self.many[~whole]) - self.many[~whole]
        self.word_at, self.words = numbers, words
        own = pc.or_(pc.greater(pc.utf8_length(words), LONG_WORD),
                     pc.match_substring(words, BETWEEN)).to_numpy(zero_copy_only=False)
        self.own, asked = np.flatnonzero(own), np.flatnonzero(~own)
        digests = map(xxhash.xxh32_intdigest, words.take(asked).cast(pa.binary()).to_pylist())
        bucket = np.fromiter(digests, np.int64, len(asked)) % buckets
        order = np.argsort(bucket, kind="stable")
        self.asked, bucket = asked[order], bucket[order] + buckets * (block % salts)
        self.buckets, self.starts = np.unique(bucket, return_index=True)
        del units, alone, cut, coded, order
        pa.default_memory_pool().release_unused()  # else it is held beside the answers

    def requests(self) -> pa.StringArray:
        """For each bucket the words to ask for, put together."""
        cuts = pa.array(np.append(self.starts, len(self.asked)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(cuts, self.words.take(self.asked)), BETWEEN)

    def encoded(self, vocabulary: Vocabulary, answers: pa.StructArray | None
                ) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
        """The parts with the ids of their texts, from the answers for their words."""
        lengths, ids = np.zeros(len(self.words), np.int64), []
        if answers is not None and len(answers):
            turn = pa.array(np.argsort(answers.field("bucket").to_numpy(zero_copy_only=False)))
            found, sizes = (answers.field(c).take(turn).flatten().to_numpy(zero_copy_only=False)
                            for c in ("ids", "sizes"))
            # At most four ids for each of LONG_WORD characters, so 128 were taken from sizes.
            lengths[self.asked] = sizes.astype(np.int64) + 128
            ids.append(found.astype(np.int32))
        for word in self.own.tolist():
            ids.append(np.array(encode_long(vocabulary, self.words[word].as_py()), np.int32))
            lengths[word] = len(ids[-1])
        ids = np.concatenate([np.empty(0, np.int32), *ids])
        begin, turn = np.empty(len(self.words), np.int64), np.concatenate((self.asked, self.own))
        begin[turn] = np.cumsum(lengths[turn]) - lengths[turn]
        tokens = np.concatenate(([0], np.cumsum(self.sizes)))
        at = 0
        for part in self.parts:
            cuts = tokens[at:at + part.num_rows + 1]
            units = self.numbers[cuts[0]:cuts[-1]]
            many = self.many[units]
            words = self.word_at[spread(self.first[units], many)]
            flat = ids[spread(begin[words], lengths[words])]
            of_words = np.concatenate(([0], np.cumsum(lengths[words])))
            ends = of_words[np.concatenate(([0], np.cumsum(many)))[cuts - cuts[0]]]
            yield part, pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(flat, pa.int32()),
                mask=part.column(1).is_null())
            at += part.num_rows


def _requests(vocabulary, buckets: int, salts: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column(0)[row].as_py()
                block = _Block(batch.column(1)[row].as_buffer(), number, vocabulary.value, buckets,
                               salts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.buckets, pa.int64()),
                     pa.array(np.full(len(block.buckets), number), pa.int64()), block.requests()],
                    ["bucket", "block", "words"])
                del block
                pa.default_memory_pool().release_unused()  # a worker waits with it otherwise
    return rows


def _assemble(vocabulary, buckets: int, salts: int, verify: bool):
    """Blocks with their answers as rows (doc_id, ids), or with what the ids decode to."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_bytes(vocabulary.value)
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Block(batch.column(1)[row].as_buffer(), batch.column(0)[row].as_py(),
                               vocabulary.value, buckets, salts)
                for part, ids in block.encoded(vocabulary.value, batch.column(2)[row].values):
                    yield checked(part, ids, pieces) if verify else pa.RecordBatch.from_arrays(
                        [part.column(0), ids], ["doc_id", "ids"])
                del block, part, ids
                pa.default_memory_pool().release_unused()

    def checked(part: pa.RecordBatch, ids: pa.ListArray, pieces: pa.Array) -> pa.RecordBatch:
        back = decoded_bytes(ids, pieces)
        shown = pc.replace_substring(part.column(1), SPACE, " ").to_pylist()
        same = [None if t is None else t.encode() == b for t, b in zip(shown, back, strict=True)]
        digests = [None if t is None else hashlib.sha256(b).hexdigest()
                   for t, b in zip(shown, back, strict=True)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), ids, pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
            ["doc_id", "ids", "decoded_sha256", "round_trip"])

    return rows


def piece_bytes(vocabulary: Vocabulary) -> pa.LargeBinaryArray:
    """The bytes of each id: byte pieces as bytes, spaces for space signs."""
    first = vocabulary.first_byte
    return pa.array([bytes([i - first]) if first is not None and first <= i < first + 256 else
                     text.replace(SPACE, " ").encode() for i, text in enumerate(vocabulary.texts)],
                    pa.large_binary())


def decoded_bytes(ids: pa.ListArray, pieces: pa.LargeBinaryArray) -> list[bytes]:
    """The bytes of each list of ids side by side, without the space that encoding puts first."""
    flat = ids.flatten()
    taken = pieces.take(flat)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[:len(flat) + 1] if len(flat) else np.zeros(1, int)
    data = taken.buffers()[2].to_pybytes() if len(flat) else b""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    cuts = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
    return [data[lo + data.startswith(b" ", lo, hi):hi]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def _decode(vocabulary):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_bytes(vocabulary.value)
        for batch in batches:
            ids = batch.column("ids")
            texts = [t.decode("utf-8", "replace") for t in decoded_bytes(ids, pieces)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pc.if_else(ids.is_null(), None, pa.array(texts, pa.string()))], ["doc_id", "text"])
    return rows


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(doc_id, text) of every row of ``encoded`` (doc_id, ids). Null ids give a null text, no ids an
    empty one; bytes that are no UTF-8 become replacement characters."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())
    return encoded.select("doc_id", "ids").mapInArrow(_decode(shared), "doc_id long, text string")


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None,
           block_bytes: int = BLOCK_BYTES, verify: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): the ids the model's own encoder gives.

    ``verify`` decodes the ids again and adds decoded_sha256 (lowercase hex of the decoded text) and
    round_trip (whether that is the text, space signs read as spaces); both null for null texts.

    A null text has null ids, an empty one none. Characters outside the vocabulary become their
    UTF-8 bytes' pieces (or the unknown id in a model without them). Repeated rows repeat; rows
    without a doc_id are encoded like others; other columns are left out.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or load_vocabulary()
    shared = spark.sparkContext.broadcast(vocabulary)
    # Bucketed by block, so that the answers come to the texts and the texts stay where they are.
    blocks = bucketed(docs.select("doc_id", "text").mapInArrow(
        _blocks(block_bytes), "block long, texts binary"), "block", "piece_blocks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = "smallint" if len(vocabulary.texts) <= 1 << 15 else "int"
    # Edges of a word come one after the other; beyond 128 words, the default, all would be sorted.
    if int(spark.conf.get(HASHED_GROUPS)) < WORDS_HASHED:
        spark.conf.set(HASHED_GROUPS, str(WORDS_HASHED))
    buckets, salts = 4 * WORD_TASKS * parts, 1 + blocks.select("block").count() // ASKING_BLOCKS
    asked = (blocks.select("block", "texts")
             .mapInArrow(_requests(shared, buckets, salts),
                         "bucket long, block long, words string")
             .repartition(WORD_TASKS * parts, "bucket")  # all that follows up to the answers stays in its bucket
             .select("bucket", "block", F.posexplode(F.split("words", BETWEEN))
                     .alias("number", "word")))
    words = asked.groupBy("bucket", "word").agg(
        F.collect_list(F.struct("block", "number")).alias("asks"))
    answers = (encode_words(words, vocabulary)
               .select("bucket", F.explode("asks").alias("ask"), "ids")
               .groupBy("bucket", F.col("ask.block").alias("block"))
               .agg(F.array_sort(F.collect_list(F.struct("ask.number", "ids"))).alias("found"))
               .select("block", F.struct(
                   "bucket", F.flatten("found.ids").cast(f"array<{small}>").alias("ids"),
                   F.transform("found", lambda x: (F.size(x["ids"]) - 128).cast("tinyint"))
                   .alias("sizes")).alias("answer"))
               .groupBy("block").agg(F.collect_list("answer").alias("answers")))
    more = ", decoded_sha256 string, round_trip boolean" if verify else ""
    return (blocks.join(answers, "block", "left").select("block", "texts", "answers")
            .mapInArrow(_assemble(shared, buckets, salts, verify),
                        "doc_id long, ids array<int>" + more))


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of a column of ids: pieces side by side, byte pieces as bytes, spaces for space
    signs, without the space that encoding puts first. Null ids give null."""
    first = vocabulary.first_byte
    codes = []
    for i, text in enumerate(vocabulary.texts):
        byte = first is not None and first <= i < first + 256
        codes.append(f"{i - first:02X}" if byte else text.encode().hex())
    listed = F.split(F.lit(",".join(codes)), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(
        ids, lambda i: F.get(listed, i)), "")), "UTF-8")
    return F.regexp_replace(F.replace(text, F.lit(SPACE), F.lit(" ")), "^ ", "")


def op9_piece_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document, and whether they give its text back."""
    return encode(table(spark, folder, "documents"), verify=True)
