"""Exact top-k search with vector-approximation files (operator 2).

Vectors are packed into blocks. Each block keeps, beside its exact integer vectors, a quantised cell
per dimension (CELLS equal slices of the block's range). For a query the cells give a score with a
known error, so a scan of them bounds every score from above and below. Exact vectors are then read
where the bound is not below the k-th exact score that the query has, from this block or an earlier
one. Equal vectors are one entry of a block with their k + 1 smallest ids, so a vector that fills a
third of the table costs one row.

Blocks of queries meet slices of the rows by an equi-join on the slice's number, so no task holds
all rows or all queries. Queries are repeated for every slice, after their size is known to the
optimizer, so that join is always a merge join: a broadcast would take queries times slices through
the driver. A task reads one block of queries after the other against the blocks of its slice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderdw.llm.common import spread, table
from orderdw.session import cut_lineage

K, SCALE, CELLS, BLOCK_ROWS, BLOCK_QUERIES, EVERY = 10, 1024, 16, 4096, 512, 100
# Rows are cut into so many slices where there are blocks enough, and into more where a slice, which a
# task holds, would be larger than this: what queries take in the shuffle grows with the slices.
SLICES, SLICE_BYTES = 128, 16 << 20
EXACT, PAIRS = 2 ** 53, 8192
PACKED = "dim int, n int, ids binary, values binary"
APPROXIMATED = PACKED + ", copies binary, cells binary, low binary, width binary"


class Block(NamedTuple):
    ids: np.ndarray     # of the copies of each vector, ascending, k + 1 at most
    values: np.ndarray  # the different vectors
    copies: np.ndarray  # how many ids each has
    cells: np.ndarray   # which of the equal slices of its range each component lies in
    low: np.ndarray
    width: np.ndarray   # of a cell, per dimension


def _valid(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", "embedding").filter(
        "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding,"
        " x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def approximated(ids: np.ndarray, values: np.ndarray, k: int, cells: int) -> Block:
    """The rows of a block with their approximation."""
    order = np.lexsort(ids[None])
    ids, values = ids[order], values[order]
    distinct, group = np.unique(values, axis=0, return_inverse=True)
    group = group.ravel()
    by_group = np.argsort(group, kind="stable")  # ids stay in order within equal vectors
    sizes = np.bincount(group, minlength=len(distinct))
    starts = np.cumsum(sizes) - sizes
    copies = np.minimum(sizes, k + 1)
    low = distinct.min(axis=0).astype(np.float64)
    width = np.maximum((distinct.max(axis=0) - low) / cells, 1e-9)
    cell = np.minimum((distinct - low) / width, cells - 1).astype(np.uint8)
    return Block(ids[by_group[spread(starts, copies)]], distinct, copies, cell, low, width)


def _bytes(values: np.ndarray) -> bytes:
    """In the narrowest of 2, 4 and 8 bytes each that holds all of them."""
    most = max((abs(int(x)) for x in (values.min(), values.max())), default=0)
    return values.astype("<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<i8").tobytes()


def _vectors(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (n * dim)}").reshape(n, dim).astype(np.int64)


def _pack(most: int, approximate=None):
    """Rows of a partition as blocks of integer vectors of one length."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            more = []
            if approximate:
                ids, values, copies, *rest = approximate(ids, values)
                more = [copies.astype("<i4").tobytes(), *[x.tobytes() for x in rest]]
            binary = [ids.astype("<i8").tobytes(), _bytes(values), *more]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([len(values)], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in binary]],
                ["dim", "n", "ids", "values", "copies", "cells", "low", "width"][:2 + len(binary)])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * SCALE)
            limit = float(2 ** 62)
            whole = np.clip(whole, -limit, limit).astype(np.int64)
            dims = np.diff(offsets)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), most):
                    some = at[lo:lo + most]
                    held.setdefault(dim, []).append(
                        (ids[some], whole[offsets[some][:, None] + np.arange(dim)]))
                    if sum(len(x[0]) for x in held[dim]) >= most:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)
    return rows


def _products(queries: np.ndarray, values: np.ndarray):
    """Integer inner products of pairs, told by their places; by floating point where that is exact."""
    most = float(np.abs(queries).max()) * float(np.abs(values).max()) * queries.shape[1]
    if most < EXACT:
        queries, values = queries.astype(np.float64), values.astype(np.float64)

    def of(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.empty(len(q), np.int64)
        for lo in range(0, len(q), PAIRS):
            part = slice(lo, lo + PAIRS)
            out[part] = np.einsum("ij,ij->i", queries[q[part]], values[v[part]])
        return out
    return of


def _middles(queries: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the queries with the centres of all cells, and by how much a query's may be wrong."""
    q = queries.astype(np.float64)
    steps = q * block.width
    # Half a cell in each dimension; and rounding, for which sums of the absolute values stand.
    slack = np.abs(steps).sum(axis=1) / 2
    size = np.abs(q) @ np.maximum(np.abs(block.low), np.abs(block.low + block.width * 256))
    size += 256 * np.abs(steps).sum(axis=1)
    kind = np.float32 if size.max(initial=0) < 1e30 else np.float64
    slack += 2 * (queries.shape[1] + 8) * np.finfo(kind).eps * (1 + size)
    middles = steps.astype(kind) @ block.cells.T.astype(kind)
    middles += (q @ block.low + steps.sum(axis=1) / 2).astype(kind)[:, None]
    return middles, slack


def best_of_block(queries: np.ndarray, block: Block, k: int, floor: np.ndarray):
    """(query's place, vector's place, score) of all pairs that can be among the k best of the query,
    whose k-th exact score so far is ``floor`` (minus infinity, where it has fewer)."""
    middles, slack = _middles(queries, block)
    exact = _products(queries, block.values)
    new = np.flatnonzero(~np.isfinite(floor))
    if len(new) and len(block.values) > k:
        # Of k + 1 different vectors one is the query's own row at most.
        first = np.argpartition(middles[new], -k - 1, axis=1)[:, -k - 1:]
        scores = exact(np.repeat(new, k + 1), first.ravel()).reshape(-1, k + 1)
        floor = floor.copy()
        floor[new] = scores.min(axis=1)
    # Rounded down, so that no comparison in the narrow type loses a pair.
    least = np.nextafter((floor - slack).astype(middles.dtype), middles.dtype.type(-np.inf))
    q, v = np.nonzero(middles >= least[:, None])
    scores = exact(q, v)
    good = scores >= floor[q]
    return q[good], v[good], scores[good]


def best_of_both(found, others, k: int):
    """The k best (query's place, score, id) of each query, in order, of two such lists."""
    q, scores, ids = (np.concatenate(x) for x in zip(found, others, strict=True))
    order = np.lexsort((ids, -scores, q))
    q, scores, ids = q[order], scores[order], ids[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return tuple(x[place < k] for x in (q, scores, ids))


def _search(k: int):
    """Blocks of queries with blocks of rows. What a block of queries has found is kept as long as rows
    of the same one follow; in whatever order they come, all that can be among the best is given."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = q_ids = queries = floor = None
        none = (np.empty(0, np.int64),) * 3
        found = none

        def told() -> pa.RecordBatch:
            q, scores, ids = found
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (q_ids[q], ids, scores)],
                ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                dim, n = row["dim"].as_py(), row["n"].as_py()
                key = (dim, row["q_ids"].as_py(), row["q_values"].as_py())
                if key != asked:
                    if asked is not None:
                        yield told()
                    asked, found = key, none
                    q_ids = np.frombuffer(key[1], "<i8")
                    queries = _vectors(key[2], dim, len(q_ids))
                    floor = np.full(len(q_ids), -np.inf)
                block = Block(
                    np.frombuffer(row["ids"].as_buffer(), "<i8"),
                    _vectors(row["values"].as_buffer(), dim, n),
                    np.frombuffer(row["copies"].as_buffer(), "<i4"),
                    np.frombuffer(row["cells"].as_buffer(), np.uint8).reshape(n, dim),
                    *[np.frombuffer(row[c].as_buffer(), "<f8") for c in ("low", "width")])
                q, v, scores = best_of_block(queries, block, k, floor)
                starts = np.cumsum(block.copies) - block.copies
                ids = block.ids[spread(starts[v], block.copies[v])]
                q, scores = (np.repeat(x, block.copies[v]) for x in (q, scores))
                other = ids != q_ids[q]  # a query is no candidate of its own
                found = best_of_both(found, (q[other], scores[other], ids[other]), k)
                last = np.flatnonzero(np.bincount(found[0], minlength=len(q_ids)) == k)
                floor[last] = found[1][np.searchsorted(found[0], last, side="right") - 1]
        if asked is not None:
            yield told()
    return rows


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of every query with the
    rows of ``vectors`` other than its own, ties to the smaller vec_id.

    Both frames have vec_id and embedding; components become floor(1024 * x). Vectors that are null,
    empty or hold null or non-finite components, and rows without a vec_id, take no part. Vectors of
    different lengths have no score with each other. Repeated rows count each. Fewer than k
    candidates give fewer rows; an empty table gives none.
    """
    rows = cut_lineage(_valid(vectors).mapInArrow(
        _pack(BLOCK_ROWS, lambda ids, values: approximated(ids, values, k, cells)), APPROXIMATED),
        "va-rows")
    asked = _valid(queries)
    asked = cut_lineage(asked.repartition(max(1, math.ceil(asked.count() / BLOCK_QUERIES)))
                        .mapInArrow(_pack(BLOCK_QUERIES), PACKED), "va-queries")
    size, held = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(
        F.sum(sum(F.length(c) for c in ("ids", "values", "cells"))), F.lit(0))).first()
    slices = max(1, min(math.ceil(size / BLOCK_ROWS), max(SLICES, math.ceil(held / SLICE_BYTES))))
    right = rows.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)))
    left = (asked.select("dim", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
            .withColumn("slice", F.col("slice").cast("long")))
    best = (left.hint("merge").join(right, ["dim", "slice"]).drop("slice")
            .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_va_file(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the ten best rows for each vec_id divisible by 100."""
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum([a * c.e[i] FOR a, i IN q.e]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
      AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
