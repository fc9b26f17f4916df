"""Full refreshes that readers survive: all tables of a release come into force at once."""

from __future__ import annotations

import json
from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, types as T

from orderdw.schemas import TABLES
from orderdw.sources.files import folders, remove
from orderdw.sources.manifest import change, latest
from orderdw.sources.tables import MANIFEST, RELEASES, write_table


class Release:
    """Tables written beside those in force. Used as a context, it publishes them when its block
    ends and drops them when the block fails."""

    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.target = spark, target
        self.name = uuid4().hex
        self.tables: dict[str, T.StructType] = {}

    def __enter__(self) -> Release:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            remove(self.spark, f"{self.target}/{RELEASES}/{self.name}")

    def write(self, name: str, df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
        """Store a table of the release and read it back."""
        path = f"{self.target}/{RELEASES}/{self.name}/{name}"
        write_table(df, path, partition_by=partition_by)
        self.tables[name] = df.schema
        return _read(self.spark, path, df.schema)

    def publish(self) -> None:
        """The release's tables replace those of the same name; others stay as they are."""
        mine = {name: {"release": self.name, "schema": schema.json()}
                for name, schema in self.tables.items()}
        change(self.spark, f"{self.target}/{MANIFEST}", lambda now: {**(now or {}), **mine})


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(TABLES.get(path.rsplit("/", 1)[-1], schema)).parquet(path)


def published(spark: SparkSession, target: str) -> list[str]:
    return sorted(latest(spark, f"{target}/{MANIFEST}")[1] or {})


def load_published(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the release in force. The files it names stay until :func:`drop_replaced`."""
    now = latest(spark, f"{target}/{MANIFEST}")[1] or {}
    if name not in now:
        raise LookupError(f"no table {name} is published in {target}")
    schema = T.StructType.fromJson(json.loads(now[name]["schema"]))
    return _read(spark, f"{target}/{RELEASES}/{now[name]['release']}/{name}", schema)


def refresh(df: DataFrame, target: str, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Full refresh of one table: DELETE and INSERT in one step. ``df`` may read the old table."""
    with Release(df.sparkSession, target) as release:
        release.write(name, df, partition_by)
    return load_published(df.sparkSession, target, name)


def drop_replaced(spark: SparkSession, target: str) -> list[str]:
    """Remove the tables that no release in force names, once nobody reads them any more."""
    now = latest(spark, f"{target}/{MANIFEST}")[1] or {}
    live = {(entry["release"], name) for name, entry in now.items()}
    gone = []
    for release, at in folders(spark, f"{target}/{RELEASES}").items():
        for name, path in folders(spark, at).items():
            if (release, name) not in live:
                remove(spark, path)
                gone.append(f"{release}/{name}")
        if not any(r == release for r, _ in live):
            remove(spark, at)
    return sorted(gone)
