"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderdw.session import cut_and_measure


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, smallest): for every node of ``links`` (a, b) the smallest node it can reach.

    Each round hangs every node's larger neighbours under its smallest neighbour, then every node
    and its smaller neighbours under the smallest of them. The links end as stars around the
    smallest nodes; the number of rounds grows with the logarithm of the longest path. Neighbours
    are never gathered in one place: the minimum is an aggregate, and the join with it can be split.
    Each round is written to the shared folder, where its checksum shows whether it changed anything.
    """
    pairs = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    pairs, seen = _stored(pairs.filter("u < v").distinct())
    while True:
        both = pairs.select("v", "u").unionByName(pairs.select(F.col("u").alias("v"),
                                                               F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        large = (both.filter("u > v").join(low, "v")
                 .select(F.col("u").alias("v"), F.col("m").alias("u")).distinct())
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(low, "v")
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v")
        small = small.unionByName(low.select("v", F.col("m").alias("u"))).distinct()
        pairs, now = _stored(small)
        if now == seen:
            break
        seen = now
    ends = pairs.select(F.col("v").alias("node"), F.col("u").alias("smallest"))
    roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("smallest")).distinct()
    return ends.unionByName(roots)


def _stored(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    stored, seen = cut_and_measure(
        pairs, "links", rows=F.count("*"),
        a=F.bit_xor(F.xxhash64("v", "u")), b=F.bit_xor(F.xxhash64("u", "v")))
    return stored, (seen["rows"], seen["a"], seen["b"])
