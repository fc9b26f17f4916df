"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderdw.sources.testdata import OrderModel, load_test_table, order_model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


@dataclass(frozen=True)
class Inputs:
    spark: SparkSession
    folder: str

    @cached_property
    def m(self) -> OrderModel:
        return order_model(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return load_test_table(self.spark, self.folder, name)


def shown(df: DataFrame) -> DataFrame:
    """Binary columns as hex text, so that results compare across engines."""
    return df.select(*[F.lower(F.hex(c)).alias(c) if t == "binary" else F.col(c)
                       for c, t in df.dtypes])


def query(name: str, sql: str | None = None):
    def keep(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: shown(build(Inputs(spark, folder)))
        if sql is not None:
            ORACLE[name] = sql
        return build
    return keep
