"""Repricing by origin."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderdw.functions.scalars import as_money, percent_factor


def reprice(products: DataFrame, origin: str, pct: Decimal | int | str) -> DataFrame:
    """Change the price of the products of one origin by ``pct`` percent, to two places."""
    changed = as_money(F.col("unit_price") * percent_factor(pct))
    return products.withColumn("unit_price", F.when(F.col("origin") == origin, changed)
                               .otherwise(F.col("unit_price")))


def price_change_report(old: DataFrame, new: DataFrame, origin: str) -> DataFrame:
    before = old.filter(F.col("origin") == origin).select(
        "product_id", "description", F.col("unit_price").alias("price_before"))
    after = new.filter(F.col("origin") == origin).select(
        "product_id", F.col("unit_price").alias("price_after"))
    return (before.join(after, "product_id")
            .select("description", "price_before", "price_after", "product_id")
            .orderBy("description", "product_id").drop("product_id"))


def caption(spark: SparkSession, text: str) -> DataFrame:
    """A constant relation of one row, used as a heading."""
    return spark.range(1).select(F.lit(text).alias("description"))


def price_listing(products: DataFrame, origin: str, heading: str) -> DataFrame:
    """Current prices of one origin under a heading row."""
    top = caption(products.sparkSession, heading).select(
        F.lit(0).alias("section"), "description",
        F.lit(None).cast("decimal(10,2)").alias("current_price"))
    rows = products.filter(F.col("origin") == origin).select(
        F.lit(1).alias("section"), "description", F.col("unit_price").alias("current_price"))
    return top.unionByName(rows).orderBy("section", "description", "current_price")
