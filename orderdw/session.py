"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from orderdw.sources.files import remove

# Joins are left to the optimizer: a side is broadcast only when its size, estimated or measured at
# run time, is under spark.sql.autoBroadcastJoinThreshold. Skewed join partitions are split at run
# time, also where that costs another shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "orderdw", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. ``extra`` keys use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Where it is unset, a local session keeps the intermediate tables in its warehouse folder; on a
    cluster that might lie on one machine, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    return named.rstrip("/")


def stage_table(spark: SparkSession, label: str) -> str:
    """An unused name for an intermediate table that is kept in the catalog."""
    return f"{_tables_of(spark)}{label}_{uuid4().hex}"


def _tables_of(spark: SparkSession) -> str:
    return "stage_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower() + "_"


def stage_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder for an intermediate table of this application."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark)}/orderdw/{app}/{label}-{uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application, once its results are written."""
    for found in spark.catalog.listTables(pattern=f"{_tables_of(spark)}*"):
        spark.sql(f"DROP TABLE IF EXISTS `{found.name}`")
    remove(spark, f"{checkpoint_dir(spark)}/orderdw/{spark.sparkContext.applicationId}")


@contextmanager
def without_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind: later work starts from what is written.
    Otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later work starts from the files, so a lost executor costs only the tasks it ran, and values
    that depend on the partitioning (row slots) are fixed once. Parquet is used rather than
    ``checkpoint()`` so that later steps read only the columns they need and have real sizes.
    """
    path = stage_path(df.sparkSession, label)
    with without_shuffles_left(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Remove the files of a frame that :func:`cut_lineage` gave, when nothing will read it again."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


def cut_and_measure(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """As :func:`cut_lineage`, with aggregates that are taken while the rows are written."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]), label)
    return stored, seen.get
