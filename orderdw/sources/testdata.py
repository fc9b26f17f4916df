"""The Parquet test tables seen as the order model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderdw.functions.ids import stable_key
from orderdw.schemas import CANCELLED, CONFIRMED, IMPORTED, NATIONAL, PENDING, TEST_TABLES


def load_test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def int_key(c: Column) -> Column:
    """A whole number as 16 bytes, keeping its order."""
    return F.unhex(F.lpad(F.hex(c.cast("long")), 32, "0"))


@dataclass(frozen=True)
class OrderModel:
    customers: DataFrame
    suppliers: DataFrame
    sellers: DataFrame
    products: DataFrame
    orders: DataFrame
    lines: DataFrame


def order_model(spark: SparkSession, folder: str) -> OrderModel:
    customer = load_test_table(spark, folder, "customer")
    supplier = load_test_table(spark, folder, "supplier")
    part = load_test_table(spark, folder, "part")
    orders = load_test_table(spark, folder, "orders")
    lineitem = load_test_table(spark, folder, "lineitem")
    # Each is one value, computed once by Spark as a scalar subquery.
    n_suppliers = supplier.select(F.count("*")).scalar()
    n_customers = customer.select(F.count("*")).scalar()

    def most(n: Column) -> Column:  # so that a tenth of them never had an order
        return F.floor(n * F.lit(9) / F.lit(10))

    def mail(name: str) -> Column:
        return F.concat(F.lower(name), F.lit("@example.com"))

    def place(key: str) -> Column:
        return F.concat(F.lit("Nation "), F.col(key))

    return OrderModel(
        customers=customer.select(
            int_key(F.col("c_custkey")).alias("customer_id"),
            F.col("c_custkey").cast("string").alias("dni"), F.col("c_name").alias("surname"),
            F.col("c_mktsegment").alias("names"), place("c_nationkey").alias("address"),
            mail("c_name").alias("email")),
        suppliers=supplier.select(
            int_key(F.col("s_suppkey")).alias("supplier_id"), F.col("s_name").alias("name"),
            place("s_nationkey").alias("address"), mail("s_name").alias("email")),
        sellers=supplier.select(
            int_key(F.col("s_suppkey")).alias("seller_id"),
            F.col("s_suppkey").cast("string").alias("dni"), F.col("s_name").alias("surname"),
            place("s_nationkey").alias("names"), mail("s_name").alias("email"),
            (F.col("s_suppkey") % 30).cast("decimal(5,2)").alias("commission")),
        products=part.select(
            int_key(F.col("p_partkey")).alias("product_id"),
            F.concat_ws(" ", "p_name", "p_brand").alias("description"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            (F.col("p_size") * 20).alias("stock"), F.lit(800).alias("stock_max"),
            F.lit(100).alias("stock_min"),
            int_key(F.col("p_partkey") % n_suppliers).alias("supplier_id"),
            F.when(F.col("p_type").isin("ECONOMY", "SMALL", "PROMO"), NATIONAL)
            .otherwise(IMPORTED).alias("origin")),
        orders=orders.select(
            int_key(F.col("o_orderkey")).alias("order_id"), F.col("o_orderkey").alias("order_no"),
            int_key(F.col("o_custkey") % most(n_customers)).alias("customer_id"),
            int_key(F.col("o_orderkey") % most(n_suppliers)).alias("seller_id"),
            F.col("o_orderdate").alias("order_date"),
            F.when(F.col("o_orderstatus") == "F", CONFIRMED)
            .when(F.col("o_orderstatus") == "O", PENDING).otherwise(CANCELLED).alias("state")),
        lines=lineitem.select(
            stable_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.col("l_quantity").cast("int"),
                       F.col("l_extendedprice").cast("decimal(10,2)")).alias("line_id"),
            F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"),
            int_key(F.col("l_partkey")).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price")),
    )
