"""SimHash near-duplicates with pivot distance tables (operator 8).

Every distinct fingerprint gets a row of a pivot table: its Hamming distances to PIVOTS reference
fingerprints. Two fingerprints within r bits differ by at most r in each of these distances, so the
largest coordinate difference discards nearly all pairs before any bits are compared. To bring pairs
together without comparing everything with everything, the 64 bits are cut into 6 blocks: with at
most 4 differing bits at least 2 blocks agree, so a linked pair shares one of the 15 pairs of blocks.
Equal fingerprints are one node. A group of fingerprints that is too large for one task is split
into slices, and each pair of slices is a group of its own. Groups give links that join what they
link (a forest), never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import table, text_key
from orderdw.llm.components import smallest_reachable
from orderdw.session import cut_lineage

WORDS, RADIUS, SEED, PIVOTS, SLICE = 4, 4, 42, 16, 2048
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]  # (first bit, bits)
LANE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"
                          ).astype(np.int64)
LANES = np.arange(8, dtype=np.int64) * 256


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of their own numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(count)], np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of a whole text over its word shingles, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z, ASCII space only
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, SEED)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-words])).tolist()
    stops = (ends[words - 1:] - 1).tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)],
                      "<u8")
    seen = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + LANES
    counts = np.bincount(seen.ravel(), minlength=2048).reshape(8, 256) @ LANE_BITS
    bits = (2 * counts.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()],
                              np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64()), batch.column(2)],
                ["doc_id", "fp", "text_key"])
    return rows


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp, text_key) of every row. Null, empty and word-free texts have fingerprint zero; texts with
    fewer words than a shingle are one shingle."""
    return docs.select("doc_id", "text", text_key().alias("text_key")).mapInArrow(
        _fingerprints(words), "doc_id long, fp long, text_key long")


def _block_keys() -> Column:
    """One key for each pair of blocks: which pair, and the bits of both."""
    def block(i: int) -> Column:
        first, bits = BLOCKS[i]
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    return F.array(*[F.shiftleft(F.shiftleft(block(a), 11).bitwiseOR(block(b)), 4)
                     .bitwiseOR(F.lit(n).cast("long"))
                     for n, (a, b) in enumerate(combinations(range(6), 2))])


def close_pairs(fps: np.ndarray, tables: np.ndarray, left: np.ndarray, right: np.ndarray,
                radius: int) -> Iterator[tuple[int, int]]:
    """Index pairs (left, right) within ``radius`` bits: pivot tables first, then the bits."""
    order = right[np.argsort(tables[right, 0], kind="stable")]
    near = tables[order, 0]
    for i in left.tolist():
        row = tables[i]
        lo, hi = np.searchsorted(near, [row[0] - radius, row[0] + radius + 1])
        cand = order[lo:hi]
        for p in range(1, tables.shape[1]):
            if not len(cand):
                break
            cand = cand[np.abs(tables[cand, p] - row[p]) <= radius]
        cand = cand[cand != i]
        for j in cand[np.bitwise_count(fps[cand] ^ fps[i]) <= radius].tolist():
            yield i, j


def _links(radius: int):
    def find(parent: list[int], i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def of_group(fps: np.ndarray, tables: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
        n = len(fps)
        if n == 2:
            near = (np.abs(tables[0] - tables[1]).max() <= radius
                    and int(fps[0] ^ fps[1]).bit_count() <= radius)
            return [(0, 1)] if near else []
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if not len(left) or not len(right):  # a slice with itself
            left = right = np.arange(n)
        parent, out = list(range(n)), []
        for i, j in close_pairs(fps, tables, left, right, radius):
            a, b = find(parent, i), find(parent, j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            cuts = lists.offsets.to_numpy()
            cells = lists.values
            fps, docs, sides = (cells.field(n).to_numpy(zero_copy_only=False)
                                for n in ("fp", "doc_id", "side"))
            fps = fps.view(np.uint64)
            tables = np.frombuffer(b"".join(cells.field("table").to_pylist()), np.uint8
                                   ).reshape(len(fps), -1).astype(np.int16)
            a, b = [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                for i, j in of_group(fps[lo:hi], tables[lo:hi], sides[lo:hi]):
                    a.append(docs[lo + i])
                    b.append(docs[lo + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             ["a", "b"])
    return rows


def links(nodes: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """Links (a, b) between the doc_ids of ``nodes`` (fp, doc_id; distinct fps) that join all
    fingerprints within ``radius`` (at most 4) bits, directly or through others."""
    if not 0 <= radius <= 4:
        raise ValueError("six blocks find pairs of up to four differing bits")
    refs = [int(p) - (1 << 64) if p >> 63 else int(p) for p in map(int, pivots())]
    distances = [F.lpad(F.hex(F.bit_count(F.col("fp").bitwiseXOR(F.lit(r).cast("long")))
                              .cast("long")), 2, "0") for r in refs]
    tabled = nodes.withColumn("table", F.unhex(F.concat(*distances)))  # a byte for each pivot
    keyed = tabled.withColumn("key", F.explode(_block_keys()))
    sizes = keyed.groupBy("key").count().filter("count > 1")
    met = keyed.join(sizes, "key")
    n = F.ceil(F.col("count") / slice_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    met = (met.withColumn("n", n).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
           .select("key", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"),
                   F.struct("fp", "doc_id", "table", (F.col("own") > F.col("other")).cast("int")
                            .alias("side")).alias("row")))
    groups = met.groupBy("key", "s", "t").agg(F.collect_list("row").alias("rows"))
    return (groups.filter(F.size("rows") > 1).select("rows")
            .mapInArrow(_links(radius), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: fingerprints link at ``radius`` or fewer differing
    bits, and component_id is the smallest doc_id reachable. Equal fingerprints are linked, zero
    like any other. Repeated rows repeat in the result; rows without a doc_id are linked but never
    name a component."""
    return _components(docs, words, radius).select("doc_id", "fp", "component_id")


def _components(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """:func:`near_duplicates` with the columns that :func:`fingerprints` gives."""
    prints = cut_lineage(fingerprints(docs, words), "simhash")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
                        .filter("doc_id is not null"), "simhash-nodes")
    reach = smallest_reachable(cut_lineage(links(nodes, radius), "simhash-links"))
    named = nodes.select("fp", F.col("doc_id").alias("node")).join(reach, "node", "left").select(
        "fp", F.coalesce("smallest", "node").alias("component_id"))
    return prints.join(named, "fp", "left")


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: that of its smallest doc_id. Of several texts
    with that id one stays, the one of the smallest hash. Repeated rows are one document and stay,
    or go, together; rows without a doc_id stay."""
    found = _components(docs, words, radius).filter("doc_id is not null")
    first = found.groupBy("component_id").agg(
        F.min(F.struct("doc_id", "text_key")).alias("_first"))
    gone = (found.join(first, "component_id")
            .filter(F.struct("doc_id", "text_key") != F.col("_first"))
            .select("doc_id", F.col("text_key").alias("_text_key")).distinct())
    return (docs.withColumn("_text_key", text_key())
            .join(gone, ["doc_id", "_text_key"], "left_anti").select(docs.columns))


def op8_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: every document's fingerprint and component."""
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
