"""The training-data pipeline: raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``. All but the last keep the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderdw.llm.common import table
from orderdw.llm.decontaminate import without_leaks
from orderdw.llm.line_dedup import without_repeats
from orderdw.llm.quality import good_ones
from orderdw.llm.sentencepiece_lattice import encode
from orderdw.llm.simhash_pivots import RADIUS, WORDS, one_of_each
from orderdw.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return good_ones(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link stays."""
    return one_of_each(docs, words=WORDS, radius=RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of what is left."""
    return encode(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("token_ids", token_ids)]

# The classifier and the fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
