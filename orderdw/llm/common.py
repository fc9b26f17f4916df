"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.session import stage_path, stage_table

ASCII_SPACE = " \t\n\x0b\x0c\r"
BATCH_ROWS, ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's own reader (the folder may be in any store)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """Tells rows apart that carry the same doc_id; equal rows share it."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def hash_pair(data: bytes) -> tuple[int, int]:
    """128 bits of ``data`` as two signed longs: equal for equal content, in practice only then."""
    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def packed(parts: list[pa.RecordBatch]) -> bytes:
    """Record batches of one schema as compressed bytes."""
    out = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(out, parts[0].schema, options=options) as writer:
        for part in parts:
            writer.write_batch(part)
    return out.getvalue().to_pybytes()


def unpacked(data: pa.Buffer) -> list[pa.RecordBatch]:
    with pa.ipc.open_stream(data) as reader:
        return list(reader)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1 ... of ranges, side by side."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> Iterator[None]:
    """Python functions that run in here get at most so many rows at once: with rows of texts or
    lists, a batch of the usual size takes as much memory as the function itself, on both sides."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``: joins on ``key`` then move only
    the other side."""
    spark = df.sparkSession
    name = stage_table(spark, label)
    with small_batches(spark):
        (df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
         .option("path", stage_path(spark, label)).format("parquet").saveAsTable(name))
    return spark.table(name)
