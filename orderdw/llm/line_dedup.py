"""Line deduplication with keep bitmaps (operator 10).

Each document gives one row per distinct line key: a 128-bit hash, the document and the positions of
its lines. These rows are range-partitioned by (hash, document) and sorted within each partition,
largest document first, so that one pass over a partition meets the line to keep of every key before
the lines to drop. A key that holds a third of all rows is spread over as many partitions as it
fills; the at most two keys at the edges of each partition are settled from their counts. What comes
back is a compressed bitmap per document that loses lines, never text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orderdw.llm.common import ASCII_SPACE, hash_pair, table, text_key
from orderdw.session import cut_lineage

MIN_POINTS, MIN_DOCS = 20, 3
ROW = "k1 long, k2 long, doc_id long, tid long, n_lines long, at binary"
NAMES = ["k1", "k2", "doc_id", "tid", "n_lines", "at"]
KINDS = (pa.int64(),) * 5 + (pa.binary(),)


def line_keys(text: str | None, min_points: int) -> tuple[int, dict[str, list[int]]]:
    """Number of lines, and the positions of each key that is long enough to count."""
    lines = (text or "").split("\n")
    found: dict[str, list[int]] = {}
    for i, line in enumerate(lines):
        key = line.strip(ASCII_SPACE)
        if len(key) >= min_points:
            found.setdefault(key, []).append(i)
    return len(lines), found


def _key_rows(min_points: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            docs, texts, tids = (batch.column(i).to_pylist() for i in range(3))
            for doc, text, tid in zip(docs, texts, tids, strict=True):
                merged: dict[bytes, list[int]] = {}
                n_lines, found = line_keys(text, min_points)
                for key, at in found.items():
                    merged.setdefault(key.encode("utf-8", "surrogatepass").lower(), []).extend(at)
                for key, at in merged.items():  # bytes.lower() changes A-Z only
                    for column, value in zip(out, (*hash_pair(key), doc, tid, n_lines,
                                                   np.array(at, "<u4").tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, KINDS, strict=True)], NAMES)
    return rows


def _stream(min_docs: int):
    """Within a sorted partition: rows to drop, and all rows of the keys at its two edges."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = None
        leading, docs, last_doc, held = True, 0, None, []
        out: list[tuple] = []

        def pack() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*KINDS, pa.bool_()),
                                                strict=True)], [*NAMES, "edge"])

        # ``held``: rows of the present key after its largest document while fewer than min_docs
        # documents are known; ``first``: rows of that document. A repeated doc_id is one document.
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if row[:2] != key:
                    leading, key, first, held, docs, last_doc = key is None, row[:2], [], [], 0, None
                if row[2] != last_doc:
                    docs, last_doc = docs + 1, row[2]
                if leading:
                    out.append((*row, True))
                elif docs == 1:
                    first.append(row)
                else:
                    held.append(row)
                    if docs >= min_docs:
                        out.extend((*r, False) for r in held)
                        held = []
                if len(out) >= 20_000:
                    yield pack()
                    out.clear()
        if key is not None and not leading:  # the key at the end may go on in the next partition
            out.extend((*r, True) for r in first + held)
            if docs >= min_docs:  # its drops so far stand; this row tells the next partition
                out.append((*key, None, None, None, None, True))
        if out:
            yield pack()
    return rows


def keep_bitmaps(docs: DataFrame, min_points: int = MIN_POINTS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """Bitmaps (doc_id, tid, n_lines, n_dropped, keep) of the documents that lose lines.

    A key is a line stripped of ASCII white space at both ends, with A-Z lower-cased. Keys of at
    least ``min_points`` code points found in at least ``min_docs`` documents lose all their lines
    but those in the largest doc_id that holds them. ``keep`` is a zlib-compressed bit per line
    (1: stays), lowest bit first; ``tid`` tells rows with the same doc_id apart. Rows without a
    doc_id take no part and lose nothing. Null or empty texts are one empty line. Repeated rows
    count as one document and share a bitmap. Documents without a bitmap keep every line.
    """
    spark = docs.sparkSession
    given = docs.select("doc_id", "text", text_key().alias("tid")).filter("doc_id is not null")
    keys = cut_lineage(given.mapInArrow(_key_rows(min_points), ROW), "line-keys")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["k1", "k2", F.col("doc_id").desc(), "tid"]
    found = cut_lineage(keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                        .mapInArrow(_stream(min_docs), ROW + ", edge boolean"), "line-drops")
    edges = found.filter("edge").groupBy("k1", "k2").agg(
        F.max("doc_id").alias("last"), F.countDistinct("doc_id").alias("docs"),
        F.max(F.col("doc_id").isNull()).alias("settled"))
    late = (found.filter("edge and doc_id is not null")
            .join(F.broadcast(edges), ["k1", "k2"])  # two keys a partition at most
            .filter((F.col("docs") >= min_docs) | F.col("settled")).filter("doc_id < last"))
    columns = ["doc_id", "tid", "n_lines", "at"]
    return (found.filter("not edge").select(columns).unionByName(late.select(columns))
            .groupBy("doc_id", "tid")
            .agg(F.first("n_lines").alias("n_lines"), F.collect_list("at").alias("at"))
            .mapInArrow(_bitmaps, "doc_id long, tid long, n_lines long, n_dropped long, "
                                  "keep binary"))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lost, maps = [], []
        for n, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            keep = np.ones(n, bool)
            keep[np.frombuffer(b"".join(at), "<u4")] = False
            lost.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(lost, pa.int64()),
             pa.array(maps, pa.binary())], ["doc_id", "tid", "n_lines", "n_dropped", "keep"])


@F.pandas_udf(StringType())
def kept_text(text, keep):
    """The lines of a text that its bitmap keeps, joined by a line feed; all without a bitmap."""
    return pd.Series([_kept(t, k) for t, k in zip(text, keep, strict=True)], dtype=object)


def _kept(text: str | None, keep: bytes | None) -> str | None:
    if keep is None or text is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines),
                         bitorder="little")
    return "\n".join(line for line, bit in zip(lines, bits, strict=True) if bit)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with columns _dropped and _keep; null where a row keeps every line."""
    maps = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("tid").alias("_tid"),
                          F.col("n_dropped").alias("_dropped"), F.col("keep").alias("_keep"))
    return (docs.join(maps, (docs["doc_id"] == maps["_doc"]) & (text_key() == maps["_tid"]),
                      "left").drop("_doc", "_tid"))


def without_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with only the lines that :func:`keep_bitmaps` keeps, and n_chars to match."""
    cut = with_bitmaps(docs, keep_bitmaps(docs, **options))
    cut = cut.withColumn("text", F.when(F.col("_keep").isNull(), F.col("text"))
                         .otherwise(kept_text("text", "_keep")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("_keep").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast("long")))
    return cut.select(docs.columns)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: what every document keeps, as a digest."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit(""))
                                                    .alias("text"))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    return with_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", lines.cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.sha2(F.when(F.col("_keep").isNull(), F.col("text"))
               .otherwise(kept_text("text", "_keep")), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$',
        '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id < r.last, false) AS gone
      FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
       AS kept_sha256
FROM m GROUP BY doc_id
"""
