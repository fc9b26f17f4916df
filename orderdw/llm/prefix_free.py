"""Repeated byte strings by prefix-free parsing (operator 4).

Every byte covered by a string of LENGTH bytes that also starts elsewhere is to go. A window hash
sets triggers, which depend on WINDOW bytes only; the bytes from one trigger to the end of the next
are a phrase, so equal text has equal phrases wherever it stands. Each stretch of starting positions
is put down to the phrase with the smallest hash inside its strings, so equal strings meet under one
phrase, at one distance from it. Phrases that occur once rule their strings out; phrases that always
occur in the same context are repeated as a whole; only for the phrases in between are contexts
brought together, each different context once, and their suffixes sorted by prefix doubling up to
LENGTH bytes, where equal neighbours are the repeats. Strings without a whole phrase (texts with few
triggers, such as runs of one word) stand for themselves.

Documents travel in compressed blocks, which stay where they were written; hashes, contexts and the
runs to remove move. No group is larger than the different contexts of a phrase around one string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import bucketed, packed, table, unpacked
from orderdw.session import cut_lineage

LENGTH, WINDOW, DENSITY = 200, 16, 20  # a trigger at every DENSITY-th byte on average
GRID = 50  # contexts meet by stretches of so many starting positions
BLOCK_BYTES, CHUNK_BYTES, SORT_BYTES = 4 << 20, 1 << 20, 2 << 20
SPOTS = "key long, ihash long, block long, at int, rel int, n int, copies int"
_RANDOM = np.random.Generator(np.random.PCG64(7))
TABLE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5
C1, C2, C3 = (np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * C1
    x = (x ^ (x >> np.uint64(29))) * C2
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i up to n."""
    def series(base: int) -> np.ndarray:
        out = np.empty(n + 1, np.uint64)
        out[0] = 1
        filled, step = 1, base
        while filled <= n:  # doubling: the known part times the base to its length
            take = min(filled, n + 1 - filled)
            out[filled:filled + take] = out[:take] * np.uint64(step)
            filled += take
            step = step * step % (1 << 64)
        return out
    return series(BASE), series(pow(BASE, -1, 1 << 64))


class _Slices:
    """Hashes of any slices of a buffer, in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        self.powers, self.inverse = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLE[data] * self.powers[:-1], out=self.sums[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo]
                    + (hi - lo).astype(np.uint64) * C3)


def spots(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, density: int = DENSITY
          ) -> tuple[np.ndarray, ...]:
    """Stretches of starting positions by their phrase: (key, ihash, at, rel, n).

    ``data`` holds texts that end at ``ends``. A stretch begins at ``at``, ``rel`` bytes from its
    phrase, and has ``n`` positions; ``ihash`` is the hash of all the bytes its strings cover.
    Positions without a whole phrase are stretches of their own.
    """
    starts = np.concatenate(([0], ends[:-1]))
    none = tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    fits = ends - starts >= length
    if not fits.any():
        return none
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    window = _mix(words[:-8] * C3 + words[8:])
    triggers = np.flatnonzero(window < np.uint64((1 << 64) // density))
    text = np.searchsorted(ends, triggers, "right")
    inside = triggers + WINDOW <= ends[text]
    triggers, text = triggers[inside], text[inside]
    whole = text[:-1] == text[1:]
    first, last = triggers[:-1][whole], triggers[1:][whole] + WINDOW
    slices = _Slices(data)
    phrase = slices(first, last)
    # Positions where the phrases inside a string change: beginnings of texts and of what follows
    # the start of a phrase, and where a phrase comes wholly into view.
    begins = np.sort(np.concatenate((starts[fits], first + 1, last - length)), kind="stable")
    begins = begins[np.searchsorted(begins, 0):]
    begins = begins[np.concatenate(([True], begins[1:] != begins[:-1]))]
    text = np.searchsorted(ends, begins, "right")
    begins, text = begins[text < len(ends)], text[text < len(ends)]
    good = begins + length <= ends[text]
    begins, text = begins[good], text[good]
    stops = np.minimum(np.concatenate((begins[1:], [len(data)])), ends[text] - length + 1)
    low = np.searchsorted(first, begins, "left")
    count = np.searchsorted(last, begins + length, "right") - low
    chosen = np.where(count > 0, low, -1)
    best = phrase[np.minimum(low, max(0, len(phrase) - 1))] if len(phrase) else np.zeros(
        len(low), np.uint64)
    for d in range(1, int(count.max(initial=0))):
        at = np.flatnonzero(count > d)
        hashes = phrase[low[at] + d]
        less = hashes < best[at]
        best[at[less]] = hashes[less]
        chosen[at[less]] = low[at[less]] + d
    # Neighbouring stretches with the same phrase are one.
    new = np.ones(len(begins), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (begins[1:] != stops[:-1])
    lead = np.flatnonzero(new)
    at, held = begins[lead], chosen[lead]
    end = stops[np.concatenate((lead[1:], [len(begins)])) - 1]
    has = held >= 0
    key, ihash = phrase[held[has]] if has.any() else none[0], slices(at[has], end[has] + length - 1)
    rel, n = at[has] - first[held[has]] if has.any() else none[2], (end - at)[has]
    ihash = _mix(ihash + rel.astype(np.uint64) * C1)
    out = [key, ihash, at[has], rel, n]
    if not has.all():
        alone = np.concatenate([np.arange(a, b) for a, b in zip(at[~has], end[~has], strict=True)])
        zeros = np.zeros(len(alone), np.int64)
        extra = (_mix(slices(alone, alone + length) ^ C2), zeros.view(np.uint64), alone, zeros,
                 zeros + 1)
        out = [np.concatenate(pair) for pair in zip(out, extra, strict=True)]
    return tuple(out)


def _told_apart(spots_: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], np.ndarray,
                                                         np.ndarray, np.ndarray]:
    """Each different stretch once, how often it is there (2: or more), and the runs (at, n) of the
    positions whose stretch is there more than once."""
    key, ihash, at, rel, n = spots_
    one = _mix(key ^ _mix(ihash + C3))
    order = np.argsort(one, kind="stable")
    new = np.ones(len(one), bool)
    new[1:] = one[order[1:]] != one[order[:-1]]
    lead = np.flatnonzero(new)
    size = np.diff(np.concatenate((lead, [len(one)])))
    known = np.sort(order[np.repeat(size > 1, size)])
    known = known[np.argsort(at[known], kind="stable")]
    lo, count = at[known], n[known]
    fresh = np.ones(len(lo), bool)
    fresh[1:] = lo[1:] != lo[:-1] + count[:-1]
    head = np.flatnonzero(fresh)
    runs = np.add.reduceat(count, head) if len(head) else count
    return (tuple(x[order[lead]] for x in spots_), np.minimum(size, 2), lo[head], runs)


def _block_texts(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]:
    """The bytes of all texts of a block one after the other, and where each ends."""
    parts = unpacked(data)
    texts = [(t or "").encode("utf-8", "surrogatepass")
             for p in parts for t in p.column(1).to_pylist()]
    ends = np.cumsum([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), ends, parts


def _make_blocks(block_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0

        def block() -> pa.RecordBatch:
            data = packed(held)
            name = xxhash.xxh64_intdigest(data, seed=number % (1 << 32)) - (1 << 63)
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()),
                                               pa.array([data], pa.binary())], ["block", "texts"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                held.append(batch.slice(lo, 64))
                size += held[-1].column(1).nbytes
                if size >= block_bytes:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()
    return rows


def _spot_rows(length: int, density: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, ends, _ = _block_texts(batch.column(1)[row].as_buffer())
                lo = done = 0
                while done < len(ends):  # whole texts, about CHUNK_BYTES at a time
                    upto = max(done + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
                    part = data[lo:ends[upto - 1]]
                    (key, ihash, at, rel, n), copies, begin, run = _told_apart(
                        spots(part, ends[done:upto] - lo, length, density))
                    names = ["key", "ihash", "block", "at", "rel", "n", "copies"]
                    block = batch.column(0)[row].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(ihash.view(np.int64)),
                         pa.array(np.full(len(key), block, np.int64)),
                         *[pa.array(x.astype(np.int32)) for x in (at + lo, rel, n, copies)]], names)
                    none = len(begin)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()),
                         pa.array(np.full(none, block, np.int64)),
                         pa.array((begin + lo).astype(np.int32)), pa.nulls(none, pa.int32()),
                         pa.array(run.astype(np.int32)), pa.nulls(none, pa.int32())], names)
                    lo, done = int(ends[upto - 1]), upto
    return rows


def _cores(length: int, grid: int):
    """A block's open stretches, cut where ``rel`` passes a multiple of ``grid``, as (core, block,
    at, n). All strings of a cut share the bytes between them; core is the hash of these and of the
    phrase, so only cuts with one core can hold equal strings."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, _, _ = _block_texts(batch.column(0)[row].as_buffer())
                asked = batch.column(1)[row].values
                key, at, rel, n = (asked.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                   for c in ("key", "at", "rel", "n"))
                phrase = at - rel
                firsts, stops, keys, anchors = [], [], [], []
                cell, last = np.floor_divide(rel, grid), np.floor_divide(rel + n - 1, grid)
                for step in range(int((last - cell).max(initial=0)) + 1):
                    cut = cell + step
                    on = np.flatnonzero(cut <= last)
                    firsts.append(np.maximum(rel[on], cut[on] * grid) + phrase[on])
                    stops.append(np.minimum(rel[on] + n[on], (cut[on] + 1) * grid) + phrase[on])
                    keys.append(key[on])
                    anchors.append(phrase[on] + cut[on] * grid)
                first, stop, key, anchor = map(np.concatenate, (firsts, stops, keys, anchors))
                core = _mix(_Slices(data)(anchor + grid - 1, anchor + length) ^ key.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)),
                     pa.array(np.full(len(core), batch.column(2)[row].as_py(), np.int64)),
                     pa.array(first.astype(np.int32)), pa.array((stop - first).astype(np.int32))],
                    ["core", "block", "at", "n"])
    return rows


def _contexts(length: int):
    """The bytes that the strings of the asked cuts cover."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, _, _ = _block_texts(batch.column(0)[row].as_buffer())
                asked = batch.column(1)[row].values
                at, n = asked.field("at").to_pylist(), asked.field("n").to_pylist()
                texts = [data[a:a + k + length - 1].tobytes() for a, k in zip(at, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [asked.field("core"),
                     pa.array(np.full(len(at), batch.column(2)[row].as_py(), np.int64)),
                     asked.field("at"), pa.array(texts, pa.binary())],
                    ["core", "block", "at", "context"])
    return rows


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """The rank of every suffix by its first ``length`` bytes (shorter at the end), by prefix
    doubling: equal ranks are equal strings."""
    n = len(data)
    words = np.ndarray((n,), ">u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.ravel().astype(np.int64) + 1
    known = 8
    while known < length:
        step = min(known, length - known)  # the last step overlaps, which keeps equality and order
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
        rank = rank.ravel().astype(np.int64) + 1
        known += step
    return rank


def _repeats(length: int):
    """Of contexts sorted by core: the runs of starting positions whose strings are equal to one of
    another context."""
    def resolve(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        """Cores, one after the other; positions count only within a core."""
        out: tuple[list[int], list[int], list[int]] = ([], [], [])
        data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        sizes = np.array([len(r[3]) for r in rows])
        begin = np.cumsum(sizes) - sizes
        many = sizes - length + 1
        ranks = suffix_ranks(data, length)
        row = np.repeat(np.arange(len(rows)), many)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        core = np.array([r[0] for r in rows], np.int64)
        _, core = np.unique(core, return_inverse=True)
        ids = core.ravel()[row] * (int(ranks.max()) + 1) + ranks[begin[row] + inner]
        _, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        again = counts[place.ravel()] > 1
        edge = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
        heads = np.concatenate(([0], np.cumsum(many)))
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            while lo < hi:  # a run may go on in the next context
                r = int(row[lo])
                upto = min(hi, int(heads[r + 1]))
                for column, value in zip(out, (rows[r][1], rows[r][2] + int(inner[lo]), upto - lo),
                                         strict=True):
                    column.append(value)
                lo = upto
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32()), strict=True)],
            ["block", "at", "n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= SORT_BYTES and row[0] != held[-1][0]:
                    yield resolve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield resolve(held)
    return rows


def _remove(length: int, with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield of_block(batch.column(0)[row].as_buffer(), batch.column(1)[row].values)

    def of_block(texts: pa.Buffer, runs) -> pa.RecordBatch:
        data, ends, parts = _block_texts(texts)
        change = np.zeros(len(data) + 1, np.int32)
        if runs is not None:
            at = runs.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
            n = runs.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + n + length - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        sizes, lost, spans, kept, digests = [], [], [], [], []
        lo = 0
        for hi in ends.tolist():
            mine = gone[lo:hi]
            removed = int(mine.sum())
            sizes.append(hi - lo)
            lost.append(removed)
            spans.append(int(mine[:1].sum()) + int((mine[1:] & ~mine[:-1]).sum()) if removed else 0)
            rest = (data[lo:hi][~mine] if removed else data[lo:hi]).tobytes()
            kept.append(rest if with_text else None)
            digests.append(hashlib.sha256(rest).hexdigest())
            lo = hi
        docs = pa.concat_arrays([p.column(0) for p in parts])
        return pa.RecordBatch.from_arrays(
            [docs, pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
             pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])
    return rows


def without_repeats(docs: DataFrame, length: int = LENGTH, density: int = DENSITY,
                    grid: int = GRID, block_bytes: int = BLOCK_BYTES, with_text: bool = True
                    ) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row of ``docs`` (doc_id,
    text): the UTF-8 bytes that are left without the strings of ``length`` bytes that also start
    elsewhere, in the same text or in another. Overlaps count; strings are judged on the input.

    Null and empty texts have no bytes. Every row is a text of its own, so repeated rows repeat each
    other, whatever their doc_id. Other columns are left out; ``kept`` is null unless ``with_text``.
    """
    if length < 2 * WINDOW or not 0 < grid < length:
        raise ValueError("strings must hold two triggers, and be longer than the grid")
    blocks = bucketed(docs.select("doc_id", "text").mapInArrow(
        _make_blocks(block_bytes), "block long, texts binary"), "block", "text_blocks")
    found = cut_lineage(blocks.select("block", "texts").mapInArrow(
        _spot_rows(length, density), SPOTS), "spots")
    once = found.filter("key is not null")
    # Once: no repeat. Several times with one context: repeats as a whole. Else: open.
    keys = once.groupBy("key").agg(F.sum("copies").alias("copies"), F.min("ihash").alias("lo"),
                                   F.max("ihash").alias("hi")).filter("copies > 1")
    met = cut_lineage(once.join(keys.select("key", (F.col("lo") < F.col("hi")).alias("open")),
                                "key"), "spots-met")
    same = met.filter("open").groupBy("key", "ihash").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("block", "at", "rel", "n")).alias("spot"))
    same = cut_lineage(same, "spots-open")
    whole = met.filter("not open").select("block", "at", "n")
    known = (met.filter("open").join(same.filter("copies > 1").select("key", "ihash"),
                                     ["key", "ihash"], "left_semi").select("block", "at", "n"))
    asked = same.groupBy(F.col("spot.block").alias("block")).agg(
        F.collect_list(F.struct("key", "spot.at", "spot.rel", "spot.n")).alias("asked"))
    cores = cut_lineage(blocks.join(asked, "block").select("texts", "asked", "block").mapInArrow(
        _cores(length, grid), "core long, block long, at int, n int"), "cores")
    shared = cores.groupBy("core").count().filter("count > 1")
    asked = cores.join(shared, "core", "left_semi").groupBy("block").agg(
        F.collect_list(F.struct("core", "at", "n")).alias("asked"))
    contexts = blocks.join(asked, "block").select("texts", "asked", "block").mapInArrow(
        _contexts(length), "core long, block long, at int, context binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partly = (contexts.repartition(parts, "core").sortWithinPartitions("core")
              .mapInArrow(_repeats(length), "block long, at int, n int"))
    local = found.filter("key is null").select("block", "at", "n")
    runs = (whole.unionByName(known).unionByName(partly).unionByName(local).groupBy("block")
            .agg(F.collect_list(F.struct("at", "n")).alias("runs")))
    return (blocks.join(runs, "block", "left").select("texts", "runs").mapInArrow(
        _remove(length, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                         "kept_sha256 string"))


def op4_prefix_free(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: what every document keeps, as a digest."""
    return without_repeats(table(spark, folder, "documents"), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
