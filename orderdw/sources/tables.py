"""Reading and writing the model's tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderdw.schemas import TABLES
from orderdw.sources.manifest import latest

ORDER_RANGE = "order_range"
# Where published tables lie in their folder, and which of them are in force.
RELEASES, MANIFEST = "releases", "manifest"


def load(spark: SparkSession, folder: str, name: str,
         stored_as: Mapping[str, str] | None = None) -> DataFrame:
    """A table with its declared layout; nothing is inferred from the files.

    Where ``folder`` holds published releases, the table is that of the release in force.
    ``stored_as`` names the tables that :func:`write_bucketed` stored; those come with their buckets.
    """
    if stored_as and name in stored_as:
        return spark.table(stored_as[name])
    published = (latest(spark, f"{folder}/{MANIFEST}")[1] or {}).get(name)
    path = f"{folder}/{RELEASES}/{published['release']}/{name}" if published else f"{folder}/{name}"
    return spark.read.schema(TABLES[name]).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Iterable[str] = ()) -> None:
    """INSERT ... SELECT (``append``) or a full refresh (``overwrite``).

    Spark refuses to overwrite a path that the same query reads, so a refresh always has its
    inputs elsewhere.
    """
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def by_order_range(df: DataFrame, orders_per_range: int = 1_000_000) -> DataFrame:
    """Add ``order_range`` to orders or lines, to be stored in one folder per range.

    Jobs that start from some orders (a period, a batch of cancellations) join the lines on it as
    well, and Spark then reads only the folders of those orders. Numbers are given in order of
    time, so the orders of a period lie in few folders.
    """
    return df.withColumn(ORDER_RANGE, F.floor(F.col("order_no") / orders_per_range))


def order_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """Join columns for tables that share order numbers, and order ranges if both have them."""
    both = ORDER_RANGE in left.columns and ORDER_RANGE in right.columns
    return [ORDER_RANGE, "order_no"] if both else ["order_no"]


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Store a table hashed and sorted by ``key``; tables with equal buckets join unshuffled."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .saveAsTable(table))


def write_clustered(df: DataFrame, path: str, by: str, found_by: Iterable[str], files: int,
                    rows_per_group: int = 100_000) -> None:
    """Store a table for readers that want few of its rows.

    Files follow one another along ``by`` (a date or a number: other timestamps are not compared by
    the scan) and are sorted by it, so a range of it lies in few row groups and the others are
    skipped by their limits. Each of ``found_by`` gets a Bloom filter per
    row group: a lookup of single values skips the groups that cannot hold them, wherever those
    values lie. Row groups are closed after about ``rows_per_group`` rows.
    """
    writer = (df.repartitionByRange(files, by).sortWithinPartitions(by).write
              .option("parquet.block.row.count.limit", str(rows_per_group)))
    for column in found_by:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(rows_per_group)))
    writer.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Run ``df`` and tell how many rows its Parquet scans gave out: those of the row groups that
    limits and Bloom filters did not exclude."""
    plan = df.select("*")._jdf.queryExecution().executedPlan()  # counts of its own
    plan.executeCollect()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.finalPhysicalPlan()
    total, open_ = 0, [plan]
    while open_:
        node = open_.pop()
        if "QueryStage" in node.nodeName():
            open_.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return total


def register_views(spark: SparkSession, folder: str, names: Iterable[str],
                   stored_as: Mapping[str, str] | None = None) -> list[str]:
    """Local names for tables of another folder, to be used from SQL text."""
    names = list(names)
    for name in names:
        load(spark, folder, name, stored_as).createOrReplaceTempView(name)
    return names


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """Fill missing values, and add missing columns, with each column's default."""
    filled = {}
    for name, value in defaults.items():
        value = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(filled)
