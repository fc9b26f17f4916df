"""The star-schema warehouse and its load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderdw.functions.ids import hex_text, stable_key
from orderdw.functions.scalars import concat_skip_null, date_of
from orderdw.operators.stock import with_line_total
from orderdw.sources.publish import Release, load_published
from orderdw.sources.tables import load

YEAR = "order_year"


def dim_dates(orders: DataFrame) -> DataFrame:
    """One row per day with an order, whatever the time of day."""
    day = F.col("date")
    return (orders.select(date_of(F.col("order_date")).alias("date")).distinct()
            .select(stable_key(F.lit("date"), "date").alias("date_key"), "date",
                    F.dayofmonth(day).alias("day"), F.month(day).alias("month"),
                    F.year(day).alias("year")))


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        stable_key(F.lit("customer"), hex_text("customer_id")).alias("customer_key"),
        "customer_id", concat_skip_null(F.col("surname"), F.lit(", "), F.col("names"))
        .alias("name"))


def dim_products(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    return (products.join(suppliers.select("supplier_id", F.col("name").alias("supplier_name")),
                          "supplier_id")
            .select(stable_key(F.lit("product"), hex_text("product_id")).alias("product_key"),
                    "product_id", "description", "supplier_name"))


def fact_orders(lines: DataFrame, orders: DataFrame, dates: DataFrame, customers: DataFrame,
                products: DataFrame, with_year: bool = False) -> DataFrame:
    """One row per order line whose order, day, customer and product are all known.

    The customer is looked up once per order, so the lines are joined on the order and on the product
    only. Lines in buckets of the order stay where they are for the first of these. Days are few, so
    their keys, which hardly compress, come last: what is shuffled has the day itself.
    ``with_year`` adds the order's year, to store the facts in one folder per year.
    """
    heads = (orders.select("order_no", "customer_id",
                           date_of(F.col("order_date")).alias("date"))
             .join(customers.select("customer_id", "customer_key"), "customer_id")
             .select("order_no", "date", "customer_key"))
    return (with_line_total(lines).select("order_no", "product_id", "quantity", "total")
            .join(heads, "order_no")
            .join(products.select("product_id", "product_key"), "product_id")
            .join(dates.select("date", "date_key"), "date")
            .select("customer_key", "product_key", "date_key", "quantity", "total",
                    *([F.year("date").alias(YEAR)] if with_year else [])))


def run_etl(spark: SparkSession, source: str, target: str,
            stored_as: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Full refresh of the warehouse. Keys depend on the data only, so it can be run again.

    The four tables come into force together, once the last is written; until then, and after a load
    that fails, readers find the release before (:func:`orderdw.sources.publish.load_published`).
    ``stored_as`` names source tables in buckets. The facts lie in a folder per year
    (``order_year``).
    """
    def stored(name: str) -> DataFrame:
        return load(spark, source, name, stored_as)

    with Release(spark, target) as release:
        orders = stored("orders")
        dates = release.write("dim_dates", dim_dates(orders))
        customers = release.write("dim_customers", dim_customers(stored("customers")))
        products = release.write("dim_products",
                                 dim_products(stored("products"), stored("suppliers")))
        release.write("fact_orders", fact_orders(stored("lines"), orders, dates, customers, products,
                                                 with_year=True), [YEAR])
    return {name: load_published(spark, target, name) for name in release.tables}
